"""Removal of repeated byte strings by a distributed suffix array (operator 11).

A byte goes if it lies in a string of ``LENGTH`` (100) bytes that also starts earlier: in a
document of smaller id or earlier in the same one.  What repeats is found with suffixes:
those equal in their first 100 bytes stand together in suffix order, and all but the
earliest of such a group are repeats.

Sorting every suffix of the corpus would move many times its size, so suffixes that cannot
count are discarded first, exactly:

1. ``anchors``: every 100-byte window names the least hashed 8 bytes among its first
   ``WINDOW`` places; a run of windows with one such place is an anchor.  Equal windows have
   equal anchors, so a run whose 29 bytes from the anchor on occur once in the corpus holds
   no repeat.  Runs that are equal as a whole, all their windows included, are repeats of the
   earliest of them and need not be sorted either.
2. ``eighths``: the same for the windows of a run in groups of eight by their distance to the
   anchor: those whose common 93 bytes occur once hold no repeat, and groups that are equal as
   a whole are repeats of the earliest.

What is left is written as segments of text with their open places.  Their suffixes are
ranked by ``difference_cover``: a segment is parsed into letters at places that the text
itself sets (a hash of ``MARK`` bytes; a more frequent one, or every place, where none came for
``REACH`` bytes), so letters begin alike in equal texts, none is the beginning of another, and
the order of their names is that of the bytes.  The open suffixes between two letters are merged in by the bytes
up to the next letter and its rank, and adjacent suffixes are compared by a digest of their
first 100 bytes.

Scale: the anchors (about one row per 36 bytes) are the largest shuffle.  Before it, each
batch of ``FLUSH`` anchors drops its own repeats and sends one row per 29 bytes, so a passage
in a third of all documents costs a row per batch and not per copy.  Ranges that go back to
the texts are joined by document, as a broadcast only while they take at most ``BROADCAST``
bytes.  Digests are 64 bits and compared only between neighbours or inside one group.

Edge cases: a null text is empty; texts below 100 bytes are kept whole; where a ``doc_id`` is
null or repeated every row is a document of its own, in the order of id (nulls first) and a
hash of the text; an empty table gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, shuffle_partitions, stage, table
from .difference_cover import ranked, suffix_ranks

LENGTH = 100
WINDOW = 72  # places of a window that its anchor is chosen from
SEEN = LENGTH - WINDOW + 1  # bytes from an anchor on that are inside all its windows
PIECE = 1 << 18  # bytes hashed at once
FLUSH = 250_000  # anchors looked at together before the shuffle
MARK, ODDS, MORE, REACH = 6, 16, 4, 44
BLOCK = 92  # bytes that a letter covers at least
SPAN = 1 << 16  # bytes of a segment
BROADCAST = 32 << 20

_U = np.uint64
_SALT = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _SALT
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; places near the end read zeros."""
    x = np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)]).astype(_U)
    x = x[:-1] | (x[1:] << _U(8))
    x = x[:-2] | (x[2:] << _U(16))
    return x[:-4] | (x[4:] << _U(32))


def _digest(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit digest of the ``size`` bytes (8 or more) from each place on."""
    h = np.full(len(at), size, _U)
    for k in [*range(0, size - 8, 8), size - 8]:
        h = _mix(h ^ words[at + k]) + _U(k)
    return h


def _anchors(data: np.ndarray, starts: np.ndarray) -> tuple:
    """Runs of windows of one piece: anchor, first window, number of windows, digest of the
    anchor's bytes and of the run.  ``starts`` marks the places where a window begins."""
    words = _words(data)
    n = len(data)
    place = _U(24)
    key = (_mix(words[:n]) >> place << place) | np.arange(n, dtype=_U)
    size = 1
    while 2 * size <= WINDOW:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    key = np.minimum(key[:len(key) - (WINDOW - size)], key[WINDOW - size:])
    window = np.flatnonzero(starts[:len(key)])
    anchor = (key[window] & _U((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)]))
    count = np.diff(np.append(first, len(window)))
    anchor, first = anchor[first], window[first]
    seen = _digest(words, anchor, SEEN)
    run = _digest(words, first, LENGTH) ^ _mix(_digest(words, first + count - 1, LENGTH) + ((anchor - first) * 128 + count).astype(_U))
    return anchor, first, count, seen, run


def _pieces(nums: list[int], texts: list[bytes]):
    """Texts one behind the other in pieces: bytes, where windows begin, and per piece the
    documents' numbers, where they begin in the piece and how much of them went before."""
    data, starts, place, size = [], [], [], 0
    for num, text in zip(nums, texts):
        if len(text) < LENGTH:
            continue
        lo = 0
        while lo <= len(text) - LENGTH:
            part = text[lo:lo + PIECE + LENGTH - 1]
            mark = np.zeros(len(part), bool)
            mark[:len(part) - LENGTH + 1] = True
            place.append((num, size, lo))
            data.append(np.frombuffer(part, np.uint8))
            starts.append(mark)
            size += len(part)
            lo += PIECE
            if size >= PIECE:
                yield np.concatenate(data), np.concatenate(starts), place
                data, starts, place, size = [], [], [], 0
    if data:
        yield np.concatenate(data), np.concatenate(starts), place


_ANCHOR = "key long, run long, num long, place long"
OPEN, KNOWN, PASSED, REPEAT = range(4)  # one row per 29 bytes; the same where they repeat in the batch; the others of these; repeats


def _before_shuffle(num, first, count, shift, seen, run) -> pa.RecordBatch:
    """One batch of anchors: its own repeats found, one row per 29 bytes to be compared on.
    ``place`` holds the run's first window, its number of windows, the anchor's distance and the kind."""
    by = np.lexsort((first, num, run, seen))
    num, first, count, shift, seen, run = (x[by] for x in (num, first, count, shift, seen, run))
    new = np.concatenate([[True], seen[1:] != seen[:-1]])
    own = new | np.concatenate([[True], run[1:] != run[:-1]])
    group = np.cumsum(new) - 1
    many = np.bincount(group, weights=own)[group] > 1
    kind = np.where(~own, REPEAT, np.where(~many, OPEN, np.where(new, KNOWN, PASSED)))
    settled = kind >= PASSED  # these take no part in the comparison: anywhere will do
    key = np.where(settled, _mix(num.astype(_U) * _U(31) + first.astype(_U)), seen)
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(np.where(settled, _U(0), run).view(np.int64)), pa.array(num),
         pa.array(((first * 128 + count) * 128 + shift) * 4 + kind)], names=["key", "run", "num", "place"])


def anchors(docs: DataFrame) -> DataFrame:
    """``docs(num, text)`` -> its runs of windows that may repeat, see ``compared``."""
    def scan(batches):
        held, size = [], 0
        for batch in batches:
            nums, texts = batch.column("num").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
            for data, starts, place in _pieces(nums, texts):
                anchor, first, count, seen, run = _anchors(data, starts)
                doc, at, before = (np.array(x, np.int64) for x in zip(*place))
                of = np.searchsorted(at, first, side="right") - 1
                held.append((doc[of], first - at[of] + before[of], count, anchor - first, seen, run))
                size += len(first)
                if size >= FLUSH:
                    yield _before_shuffle(*(np.concatenate(x) for x in zip(*held)))
                    held, size = [], 0
        if held:
            yield _before_shuffle(*(np.concatenate(x) for x in zip(*held)))

    return compared(docs.select("num", "text").mapInArrow(scan, _ANCHOR))


def compared(rows: DataFrame) -> DataFrame:
    """Rows of ``_before_shuffle`` -> the runs whose key occurs elsewhere too: ``(num, first, count,
    shift, repeat)``, ``repeat`` where the whole run is equal to an earlier one."""
    def compare(batches):
        held = None  # rows of the last key, until the next ones come; one row per batch before the shuffle at most
        for batch in batches:
            got = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if got.num_rows:
                key = got.column("key").to_numpy()
                last = int(np.searchsorted(key, key[-1]))  # sorted
                held = got.slice(last)
                yield from _after_shuffle(got.slice(0, last))
        if held is not None:
            yield from _after_shuffle(held)

    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "key").sortWithinPartitions("key", "run", "num", "place")
    return dealt.mapInArrow(compare, "num long, first long, count long, shift long, repeat boolean")


def _after_shuffle(rows: pa.Table):
    """Whole groups of equal 29 bytes, sorted: the runs that occur elsewhere."""
    if not rows.num_rows:
        return
    key, run, num, place = (rows.column(c).to_numpy() for c in ("key", "run", "num", "place"))
    kind = place % 4
    settled = kind >= PASSED
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    compared = np.flatnonzero(~settled)  # a settled row's key is a number of its own, if not by accident
    g, r = group[compared], run[compared]
    own = np.ones(len(compared), bool)
    own[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    n = int(group[-1]) + 1
    shared = (np.bincount(g, weights=own, minlength=n) > 1) | (np.bincount(g, weights=kind[compared] == KNOWN, minlength=n) > 0)
    repeat = kind == REPEAT
    repeat[compared] = ~own
    keep = np.flatnonzero(settled | shared[group] | repeat)
    place = place[keep] // 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(num[keep]), pa.array(place // 128 // 128), pa.array(place // 128 % 128), pa.array(place % 128), pa.array(repeat[keep])],
        names=["num", "first", "count", "shift", "repeat"])


def _with_ranges(docs: DataFrame, ranges: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` joined to the written ``ranges(num, data)``, a row per document, which is broadcast only if it is small."""
    size = ranges.agg(F.sum(F.length("data") + 64)).first()[0] or 0
    return docs.join(F.broadcast(ranges) if size <= BROADCAST else ranges, "num", how)


def _packed(rows: DataFrame, columns: list[str], then=lambda r: r) -> DataFrame:
    """Ranges of each document as one value: its rows' numbers in order, 64 bits each, as ``then`` leaves them."""
    def pack(batches):
        for batch in batches:
            lists = batch.column("rows")
            flat = np.stack([c.to_numpy() for c in lists.flatten().flatten()], 1).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            data = [then(flat[a:b]).tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("num"), pa.array(data, pa.binary())], names=["num", "data"])
    grouped = rows.groupBy("num").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows"))
    return grouped.mapInArrow(pack, "num long, data binary")


def _near(raw: bytes, ranges: np.ndarray):
    """A text's ranges in parts whose bytes lie together: the part, where its bytes begin, and these."""
    block = ranges[:, 0] // PIECE
    begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(ranges)]):
        lo = int(ranges[a, 0])
        yield ranges[a:b], lo, raw[lo:int(ranges[b - 1, 0]) + 2 * LENGTH]


def eighths(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``runs(num, first, count, shift)`` -> their eighths that may repeat, see ``compared``."""
    def cut_part(held):
        nums, ranges, los, raws = zip(*held)
        many = [len(r) for r in ranges]
        first, count, shift = np.concatenate(ranges).T
        num = np.repeat(np.array(nums, np.int64), many)
        size = np.array([len(r) for r in raws], np.int64)
        moved = np.repeat(np.cumsum(size) - size - np.array(los, np.int64), many)  # from places in a text to places in the piece
        words = _words(np.frombuffer(b"".join(raws), np.uint8))
        first, anchor, out = first + moved, first + moved + shift, []
        for k in range(0, WINDOW, 8):  # windows that begin k to k + 7 places before the anchor
            low = np.maximum(first, anchor - k - 7)
            windows = np.minimum(first + count, anchor - k + 1) - low
            some = windows > 0
            low, windows, at = low[some], windows[some], anchor[some] - k
            key = _mix(_digest(words, at, LENGTH - 7) ^ _U(k))
            whole = _digest(words, low, LENGTH) ^ _mix(_digest(words, low + windows - 1, LENGTH) + ((at - low) * 16 + windows).astype(_U))
            out.append((num[some], low - moved[some], windows, np.zeros(len(low), np.int64), key, whole))
        return _before_shuffle(*(np.concatenate(x) for x in zip(*out)))

    def cut(batches):
        for batch in batches:
            held, size = [], 0
            for num, text, data in zip(*(batch.column(c) for c in ("num", "text", "data"))):
                for part, lo, raw in _near(text.as_py().encode(), np.frombuffer(data.as_py(), np.int64).reshape(-1, 3)):
                    held.append((num.as_py(), part, lo, raw))
                    size += len(raw)
                    if size >= PIECE:
                        yield cut_part(held)
                        held, size = [], 0
            if held:
                yield cut_part(held)
    text = _with_ranges(docs, stage(_packed(runs, ["first", "count", "shift"]), "ranges"))
    return compared(text.mapInArrow(cut, _ANCHOR))


def segments(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Text that may repeat: ``(sid, num, start, data, open)``, ``open`` a flag for each byte whose suffix counts."""
    def cut(batches):
        for batch in batches:
            out = []
            for num, text, data in zip(*(batch.column(c) for c in ("num", "text", "data"))):
                raw, ranges = text.as_py().encode(), np.frombuffer(data.as_py(), np.int64).reshape(-1, 2)
                first, last = ranges[:, 0], ranges.sum(1)  # windows of a text do not overlap, as each has one anchor and distance
                begin = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1] + LENGTH - 1]))
                for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(first)]):
                    for lo in range(int(first[a]), int(last[b - 1]), SPAN):
                        hi = min(int(last[b - 1]), lo + SPAN)
                        flag = np.zeros(hi - lo + LENGTH - 1, np.uint8)
                        for x, y in zip(np.maximum(first[a:b], lo).tolist(), np.minimum(last[a:b], hi).tolist()):
                            flag[x - lo:max(x, y) - lo] = 1
                        out.append((num.as_py(), lo, raw[lo:hi + LENGTH - 1], flag.tobytes()))
            if out:
                num, lo, data, flag = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(num, pa.int64()), pa.array(lo, pa.int64()), pa.array(data, pa.binary()),
                                                  pa.array(flag, pa.binary())], names=["num", "start", "data", "open"])
    text = _with_ranges(docs, stage(_packed(ranges, ["first", "count"]), "ranges"))
    rows = text.mapInArrow(cut, "num long, start long, data binary, open binary")
    return stage(rows.withColumn("sid", F.monotonically_increasing_id()), "segments")


class _Parsed:
    """Segments one behind the other, and where their letters begin: at a hash of ``MARK`` bytes;
    at a more frequent hash if no such place was in the ``REACH`` before; at every place if
    neither was."""

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) for t in texts], np.int64)
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.raw = b"".join(texts)
        self.words = _words(np.frombuffer(self.raw, np.uint8))
        n = len(self.raw)
        place = np.arange(n)
        of = np.repeat(np.arange(len(texts)), size)
        fits = place + MARK <= self.end[of]
        hashed = _mix(self.words[:n] & _U((1 << 8 * MARK) - 1))
        rare, frequent = (hashed % _U(ODDS) == 0) & fits, (hashed % _U(MORE) == 0) & fits

        def since(mark):  # places since the last one, or since the segment's start
            last = np.maximum.accumulate(np.where(mark, place, -1))
            return place - np.maximum(np.concatenate([[-1], last[:-1]]), self.start[of] - 1)
        frequent &= rare | (since(rare) > REACH)
        neither = (since((hashed % _U(MORE) == 0) & fits) > REACH) & fits
        self.rare, self.frequent, self.neither = (np.flatnonzero(x) for x in (rare, frequent, neither))
        self.begin = np.flatnonzero(rare | frequent | neither)
        self.of = of[self.begin]
        self.first = np.searchsorted(self.of, np.arange(len(texts)))  # of each segment

    def next_letter(self, places: np.ndarray) -> np.ndarray:
        """The first letter behind each place that the 100 bytes from there show."""
        def after(begins, at):
            return np.append(begins, len(self.raw))[np.searchsorted(begins, at)]
        return np.minimum(np.minimum(after(self.rare, places), after(self.frequent, places + REACH)), after(self.neither, places + REACH))


def _few(batches, limit: int = PIECE):
    """Batches of segments in slices of about ``limit`` bytes."""
    for batch in batches:
        at = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("data")).to_numpy())]) // limit
        cut = np.flatnonzero(np.concatenate([[True], at[1:-1] != at[:-2], [True]])) if batch.num_rows else []
        for a, b in zip(cut[:-1], cut[1:]):
            yield batch.slice(int(a), int(b - a))


def letters(segs: DataFrame) -> DataFrame:
    """``(sid, j, letter, step, span)`` of every segment: a letter's bytes reach to the first
    letter ``BLOCK`` bytes on, ``step`` is how far the next one is."""
    def cut(batches):
        for batch in _few(batches):
            p = _Parsed(batch.column("data").to_pylist())
            end = p.end[p.of]
            hi = np.append(p.begin, len(p.raw) + MARK)[np.searchsorted(p.begin, p.begin + BLOCK)] + MARK
            whole = hi > end  # its segment ends first: nothing differs behind it
            hi = np.minimum(hi, end)
            step = np.minimum(np.append(p.begin[1:], len(p.raw)), end) - p.begin
            letter = [p.raw[a:b] for a, b in zip(p.begin.tolist(), hi.tolist())]
            sid = batch.column("sid").to_numpy()[p.of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sid), pa.array(np.arange(len(sid)) - p.first[p.of]), pa.array(letter, pa.binary()), pa.array(step),
                 pa.array(np.where(whole, LENGTH, hi - p.begin))], names=["sid", "j", "letter", "step", "span"])
    return segs.select("sid", "data").mapInArrow(cut, "sid long, j long, letter binary, step long, span long")


def _suffixes(segs: DataFrame, ranks: DataFrame) -> DataFrame:
    """Every open suffix: the bytes up to its next letter (hashed), that letter's rank, a digest
    of its first 100 bytes, and its place."""
    def cut(batches):
        for batch in _few(batches):
            p = _Parsed(batch.column("data").to_pylist())
            places = np.flatnonzero(np.frombuffer(b"".join(batch.column("open").to_pylist()), np.uint8))
            rank = batch.column("ranks").flatten().to_numpy()
            letter = p.next_letter(places)
            size = letter - places + MARK
            head = _mix(size.astype(_U))
            for k in range(0, 2 * REACH + MARK, 8):  # whole words, then what is left of one
                left = np.clip(size - k, 0, 8)
                part = p.words[np.minimum(places + k, len(p.words) - 1)]
                part = np.where(left > 7, part, part & ((_U(1) << (left.astype(_U) % _U(8) * _U(8))) - _U(1)))
                head = np.where(left > 0, _mix(head ^ part), head)
            of = np.searchsorted(p.end, places, side="right")
            num, start = batch.column("num").to_numpy()[of], batch.column("start").to_numpy()[of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(head.view(np.int64)), pa.array(rank[np.searchsorted(p.begin, letter)]), pa.array(_digest(p.words, places, LENGTH).view(np.int64)),
                 pa.array(num), pa.array(start + places - p.start[of])], names=["head", "rank", "digest", "num", "place"])
    lists = ranks.groupBy("sid").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "rank"))), lambda x: x["rank"]).alias("ranks"))
    return segs.join(lists, "sid").mapInArrow(cut, "head long, rank long, digest long, num long, place long")


def repeated_suffixes(segs: DataFrame) -> DataFrame:
    """``(num, place)`` of every open suffix whose first 100 bytes also start earlier."""
    with scratch(segs.sparkSession):
        named = ranked(stage(letters(segs), "letters"), ["letter"], ["sid", "j"], name="letter-names", keep=["sid", "j", "step", "span"])
        named = stage(named.select("sid", "j", (F.col("before") + 1).alias("name"), "step", "span"), "names", outer=True)
    ranks = suffix_ranks(named, LENGTH)

    def compare(batches):
        held = None  # the last group of equal suffixes; runs equal as a whole went before, so groups are small
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not rows.num_rows:
                continue
            head, digest = rows.column("head").to_numpy(), rows.column("digest").to_numpy()
            other = np.flatnonzero((head[1:] != head[:-1]) | (digest[1:] != digest[:-1]))
            last = int(other[-1]) + 1 if len(other) else 0
            held = rows.slice(last)
            yield from _later(rows.slice(0, last))
        if held is not None:
            yield from _later(held)
    order = ["head", "rank", "num", "place"]
    dealt = _suffixes(segs, ranks).repartition(shuffle_partitions(segs.sparkSession), "head").sortWithinPartitions(*order)
    return dealt.mapInArrow(compare, "num long, place long")


def _later(rows: pa.Table):
    """All but the earliest of each group of adjacent suffixes with equal first 100 bytes."""
    if not rows.num_rows:
        return
    head, digest, num, place = (rows.column(c).to_numpy() for c in ("head", "digest", "num", "place"))
    group = np.cumsum(np.concatenate([[True], (head[1:] != head[:-1]) | (digest[1:] != digest[:-1])]))
    by = np.lexsort((place, num, group))
    later = by[np.flatnonzero(np.concatenate([[False], group[by][1:] == group[by][:-1]]))]
    yield pa.RecordBatch.from_arrays([pa.array(num[later]), pa.array(place[later])], names=["num", "place"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs(num, text)``, numbers distinct and in document order -> ``(num, data)``: each
    document's maximal spans of removed bytes, as (start, end) pairs of 64-bit numbers."""
    runs = stage(anchors(docs), "anchors")
    parts = stage(eighths(docs, runs.where("NOT repeat")), "eighths")
    single = repeated_suffixes(segments(docs, parts.where("NOT repeat")))
    last = (F.col("first") + F.col("count") + LENGTH - 1).alias("hi")
    spans = (runs.unionByName(parts).where("repeat").select("num", F.col("first").alias("lo"), last)
             .unionByName(single.select("num", F.col("place").alias("lo"), (F.col("place") + LENGTH).alias("hi"))))

    def merge(ranges):  # sorted by lo
        lo, far = ranges[:, 0], np.maximum.accumulate(ranges[:, 1])
        first = np.flatnonzero(np.concatenate([[True], lo[1:] > far[:-1]]))
        return np.stack([lo[first], far[np.append(first[1:], len(lo)) - 1]], 1)
    return _packed(spans, ["lo", "hi"], merge)  # one Python step: each more of a task is a worker of its own


def numbered(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with ``num``, distinct and in document order: the id itself if every
    row has one of its own, else places in a global sort that is written once."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if not docs.groupBy("doc_id").count().where("`count` > 1 OR doc_id IS NULL").limit(1).count():
        return docs.withColumn("num", F.col("doc_id"))
    order = ["doc_id", "tie"]
    ordered = (docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
               .sortWithinPartitions(*order).withColumn("num", F.monotonically_increasing_id()))
    return stage(ordered.drop("tie"), "numbered")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``; ``kept`` holds the remaining bytes."""
    def apply(batches):
        for batch in batches:
            out = []
            for text, data in zip(batch.column("text").to_pylist(), batch.column("data").to_pylist()):
                raw = text.encode()
                spans = np.frombuffer(data, np.int64).reshape(-1, 2) if data else np.empty((0, 2), np.int64)
                at, kept = 0, []
                for lo, hi in spans.tolist():
                    kept.append(raw[at:lo])
                    at = hi
                left = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left))
            size, gone, many, sha, left = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (size, gone, many)), pa.array(sha, pa.string()), pa.array(left, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    docs = numbered(docs)
    with scratch(docs.sparkSession):
        spans = stage(repeated_spans(docs), "spans", outer=True)
    return _with_ranges(docs, spans, "left").mapInArrow(
        apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes removed from every document."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
