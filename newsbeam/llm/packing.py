"""Best-fit packing of documents into sequences by bin completion (operator 9).

Documents are tokenized, longer ones are cut into pieces of the sequence
length, and the pieces shorter than that are packed into as few sequences as
can be found.

Packing goes by bin completion: the sequence of the largest open piece is
filled next; its fillings are sets of further pieces.  A filling that another
one dominates (its pieces, alone or some together, fit in the places of an open piece
each) is not tried: a further open piece could still be added, one piece
enlarged, or several replaced by one open piece at least as long.  The depth-first
search takes the tightest filling first; a branch is left when the space it has
wasted reaches that of the best solution known (waste bound), and the first
incumbent is best-fit decreasing.  The search ends when the incumbent meets the
lower bound (total length, or the pieces no two of which fit together) or after
``NODES`` sequences have been filled anew.  Per sequence the ``WIDTH`` tightest
fillings are tried, out of up to 8 x ``WIDTH`` found in 40 x ``WIDTH`` steps.  These
bound effort, not rows: every piece is placed either way, but on groups with many
lengths the search is a beam, not a full enumeration.

Scale: tokenizing is one ``mapInArrow`` pass whose output has numbers only.
Pieces are dealt by a hash of their place in the
stored table into groups of about ``GROUP`` pieces, or more if these are so short
that they fill fewer than ``GROUP_SEQUENCES`` sequences, each packed in one task; a
group loses about one sequence against packing all at once (0.1 %), and no group
grows with the input.

Edge cases: a null text is empty, its document is the end token alone; documents
repeat as they come; an empty table packs to an empty result.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table

LENGTH = 4096
END_ID = 1
GROUP = 20_000
NODES = 60_000
WIDTH = 8  # fillings tried per sequence, the tightest of those found
GROUP_SEQUENCES = 1_000
RUN_CACHE, PART_CACHE = 600_000, 1_000_000  # distinct runs and words whose ids a Python worker remembers

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def _tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: runs of non-space characters; white space never joins two tokens of this vocabulary
_RUNS = re.compile(r"[^ \t\n\r\x0b\x0c]+")
#: runs that are surely cut between letters, single digits and other characters
_PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(r"[a-zà-öø-ÿß]+|[0-9]|[^0-9a-zà-öø-ÿß]+")


class WordTokenizer:
    """Ids of a text as little-endian 32-bit bytes.  The vocabulary works word by
    word, so ids are asked for per word and remembered (at most ``PART_CACHE`` words
    and ``RUN_CACHE`` runs)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.runs: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _ask(self, text: str) -> bytes:
        ids = self.tok.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _run(self, run: str) -> bytes:
        if not _PLAIN.fullmatch(run):
            return self._ask(run)
        parts, out = self.parts, []
        for w in _PARTS.findall(run.lower()):
            got = parts.get(w)
            if got is None:
                if len(parts) > PART_CACHE:
                    parts.clear()
                got = parts[w] = self._ask(w)
            out.append(got)
        return b"".join(out)

    def ids(self, text: str) -> bytes:
        runs, out = self.runs, []
        for w in _RUNS.findall(text):
            got = runs.get(w)
            if got is None:
                if len(runs) > RUN_CACHE:
                    runs.clear()
                got = runs[w] = self._run(w)
            out.append(got)
        return b"".join(out)


_TOKENIZERS: dict[str, WordTokenizer] = {}  # one per Python worker


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenize(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: doc_id, piece, start, length, ids_crc32."""

    def run(batches):
        words = _tokenizer(_tokenizer_path(tokenizer))
        tail = struct.pack("<I", end_id)
        step = 4 * length
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = words.ids(text.as_py() or "") + tail
                for n, at in enumerate(range(0, len(raw), step)):
                    cut = raw[at:at + step]
                    for c, v in zip(cols, (doc, n, at // 4, len(cut) // 4, zlib.crc32(cut)), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


class _Pool:
    """Open pieces by length: sorted distinct lengths with counts."""

    def __init__(self, sizes):
        self.count: dict[int, int] = {}
        for s in sizes:
            self.count[s] = self.count.get(s, 0) + 1
        self.keys = sorted(self.count)
        self.open = sum(1 << s for s in self.keys)  # bit s: a piece of length s is open

    def take(self, s):
        self.count[s] -= 1
        if not self.count[s]:
            del self.count[s]
            self.open ^= 1 << s
            self.keys.pop(bisect.bisect_left(self.keys, s))

    def put(self, s):
        if s in self.count:
            self.count[s] += 1
        else:
            self.count[s] = 1
            self.open |= 1 << s
            bisect.insort(self.keys, s)

    def below(self, gap):
        """Largest open length up to ``gap`` (0: none)."""
        k = bisect.bisect_right(self.keys, gap)
        return self.keys[k - 1] if k else 0

    def fill(self, gap):
        """Best-fit: largest piece that fits, again and again; leaves the pool as it was."""
        got = []
        while (s := self.below(gap)):
            got.append(s)
            self.take(s)
            gap -= s
        for s in got:
            self.put(s)
        return got


def _up_to(sums: int, more: int) -> int:
    """``sums`` (a set of numbers as bits) with every number raised by 0 to ``more``."""
    done = 0
    while done < more:
        step = min(done + 1, more - done)
        sums |= sums << step
        done += step
    return sums


def dominated(pool: _Pool, got: list[int], left: int) -> bool:
    """Can an open piece be added to ``got``, take the place of a smaller piece, or that of
    several pieces no larger in sum, within the ``left`` over?"""
    one, many = 0, 0  # lengths; sums of two pieces or more
    for s in got:
        many |= (many | one) << s
        one |= 1 << s
    better = _up_to(many | 1, left)
    if left:
        better |= _up_to(one << 1, left - 1)
    return bool(better & pool.open)


def fillings(pool: _Pool, gap: int, most: int) -> list[list[int]]:
    """Undominated fillings of ``gap``, tightest first, up to ``most``."""
    found: dict[tuple, int] = {}
    budget = [40 * most]

    def grow(got, gap, top):
        s = min(pool.below(gap), top)
        if not s:
            if not dominated(pool, got, gap):
                found.setdefault(tuple(got), gap)
            return
        k = bisect.bisect_right(pool.keys, s)
        while k and budget[0] > 0 and len(found) < 8 * most:
            budget[0] -= 1
            s = pool.keys[k - 1]
            pool.take(s)
            grow(got + [s], gap - s, s)
            pool.put(s)
            # a smaller last piece is dominated once this one closed the sequence
            if gap - s == 0 or gap < 2 * (pool.keys[0] if pool.keys else 1):
                return
            k = bisect.bisect_left(pool.keys, s)

    grow([], gap, gap)
    if not found:
        return [pool.fill(gap)]
    return [list(f) for f, _ in sorted(found.items(), key=lambda x: (x[1], len(x[0])))[:most]]


def best_fit_decreasing(sizes, length: int) -> list[list[int]]:
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for s in sorted(sizes, reverse=True):
        k = bisect.bisect_left(room, (s, -1))
        if k < len(room):
            gap, b = room.pop(k)
        else:
            gap, b = length, len(bins)
            bins.append([])
        bins[b].append(s)
        if gap - s:
            bisect.insort(room, (gap - s, b))
    return bins


def lower_bound(sizes, length: int) -> int:
    """Total length, sharpened by the pieces above a threshold k that leave no
    room for others (Martello and Toth)."""
    n = np.bincount(np.asarray(sizes, dtype=np.int64), minlength=length + 1)
    total = np.cumsum(n * np.arange(length + 1))
    count = np.cumsum(n)
    best = -(-int(total[-1]) // length)
    half = length // 2
    large = int(count[-1] - count[half])
    for k in {*np.flatnonzero(n[:half + 1]).tolist()}:
        big = int(count[-1] - count[length - k])                       # above length - k: alone
        mid_n = int(count[length - k] - count[half])                   # up to length - k, above half
        mid = int(total[length - k] - total[half])
        small = int(total[half] - (total[k - 1] if k else 0))
        best = max(best, big + mid_n + max(0, -(-(small - (mid_n * length - mid)) // length)))
    return max(best, large)


def pack(sizes, length: int = LENGTH, nodes: int = NODES) -> list[list[int]]:
    """Sequences as lists of piece lengths, each summing to at most ``length``."""
    best = best_fit_decreasing(sizes, length)
    bound = lower_bound(sizes, length) if len(sizes) else 0
    if len(best) <= bound:
        return best
    pool = _Pool(sizes)
    total = sum(sizes)
    done: list[list[int]] = []
    waste = 0
    stack: list[list] = []  # per depth: the untried fillings
    spent = 0

    def choose():
        top = pool.keys[-1]
        pool.take(top)
        options = fillings(pool, length - top, WIDTH)
        pool.put(top)
        return [top, options, 0]

    if pool.keys:
        stack.append(choose())
    while stack and spent < nodes and len(best) > bound:
        top, options, k = stack[-1]
        allowed = (len(best) - 1) * length - total  # waste of a better solution
        if k:  # undo the filling tried before
            old = done.pop()
            waste -= length - sum(old)
            for s in old:
                pool.put(s)
        if k >= len(options):
            stack.pop()
            continue
        stack[-1][2] += 1
        new = [top, *options[k]]
        spent += 1
        done.append(new)
        waste += length - sum(new)
        for s in new:
            pool.take(s)
        if not pool.keys:
            if len(done) < len(best):
                best = [list(x) for x in done]
            continue
        if waste > allowed:
            continue
        stack.append(choose())
    return best


def _place(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece."""
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    whole = np.flatnonzero(lengths >= length)
    seq[whole] = np.arange(len(whole))
    rest = np.flatnonzero(lengths < length)
    by: dict[int, list[int]] = {}
    for i in rest.tolist():
        by.setdefault(int(lengths[i]), []).append(i)
    for b, sizes in enumerate(pack([int(x) for x in lengths[rest]], length)):
        at = 0
        for s in sizes:
            i = by[s].pop()
            seq[i], off[i] = len(whole) + b, at
            at += s
    return seq, off


def pack_pieces(pieces: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Stored ``pieces`` -> the same rows with sequence_id and offset."""
    n, tokens = pieces.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()  # they only set how many groups there are
    groups = max(1, min(-(-n // group), tokens // (GROUP_SEQUENCES * length)))

    def run(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable", ascending=False).reset_index(drop=True)
        seq, off = _place(pdf["length"].to_numpy(), length)
        pdf["sequence_id"] = pdf["g"].to_numpy(np.int64) * (1 << 32) + seq
        pdf["offset"] = off
        return pdf.drop(columns="g")

    # by place in the stored table, so that copies of one document spread too
    g = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    return pieces.withColumn("g", g).groupBy("g").applyInPandas(run, PACKED)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_pieces(stage(tokenize(docs), "pieces"))
