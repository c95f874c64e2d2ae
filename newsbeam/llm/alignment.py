"""Alignment of two tokenizers over the same texts (operator 13).

Every text is encoded by a byte-level BPE (A, over space + text) and by a
sentence-piece BPE with byte fallback (B, over the text; it adds the space
itself).  Both token sequences spell the same bytes, so each token is a byte
range.  Per Arrow batch two ``pandas.merge_asof`` calls, keyed by document, find
for every token start the token of the other side that covers it; the union of
both directions is the set of overlapping pairs (links; a pair found by both
starts at the same byte and is taken from one side).  Byte offsets where tokens
of both sides end cut the sequences into groups.

Encoding: neither tokenizer has a token that crosses from a character other than
white space to a blank or a line feed, so a text is cut there into words whose ids are looked up
in a cache of bounded size per Python worker; new words are encoded in one call
per batch, ``JOINED`` as one text, whose ids are cut at the words' ends.  ``tests/llm`` holds this against encoding whole texts.  A batch takes
texts up to ``BATCH_BYTES``; a longer text is its own batch.

Scale: the texts are read by one ``mapInArrow`` pass that returns per document its
numbers and its distinct id pairs with their counts, written once.  Corpus-wide
counts of id pairs are a grouped sum with a map-side step.  The counts go back to
the documents' pairs by a join that is a broadcast only while the pair table has at
most ``BROADCAST_PAIRS`` rows (12 bytes each), else by shuffle; a hot pair is then
split by adaptive execution.

Edge cases: a text that is null or empty, or that one tokenizer does not spell byte
for byte (for instance one that holds U+2581), has no tokens: zeros and an empty
``groups_sha256``.  Repeated rows and null ids stay rows of their own; an empty table
gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

BATCH_BYTES = 1 << 18
CACHE_WORDS = 250_000
JOINED = 32  # new words encoded as one text
BROADCAST_PAIRS = 4_000_000

SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<struct<a: int, b: int, n: int>>")

# a cut lies between a character that is not white space and a blank or a line feed
_WORD = re.compile(r"[ \n]+(?:\S+|[^\S \n]+[ \n]*)*")


def words_of(text: str) -> list[str]:
    """The words of space + text; joined they are the text again, and each begins with a
    blank or a line feed."""
    return _WORD.findall(" " + text)


def _unicode_of_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Pair:
    """Both tokenizers with their tokens' bytes; ``encode`` gives words' ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core already
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _unicode_of_bytes()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            # an added token is no byte string; plain text never gives it
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.vocab_size())]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # each id as text with the sign behind it: within a group, then at its end
        self.text_a = np.array([f"{i}{sign}" for sign in ",|" for i in range(len(self.bytes_a))], object)
        self.text_b = np.array([f"{i}{sign}" for sign in ",;" for i in range(len(self.bytes_b))], object)
        self.blank = self.b.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}  # of each word met
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]  # of all words, A and B
        self.at = [np.zeros(1, np.int64), np.zeros(1, np.int64)]  # where each word's begin
        self.good = np.empty(0, bool)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, words: list[str]) -> np.ndarray:
        """Each word's number; new words are encoded."""
        new = list(set(words).difference(self.number))
        if len(self.number) + len(new) > CACHE_WORDS:
            self._forget()
            new = list(set(words))
        if new:
            new, flat, sizes, good = self._words(new)
            self.good = np.append(self.good, good)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            for side in (0, 1):
                self.at[side] = np.append(self.at[side], self.at[side][-1] + np.cumsum(sizes[side]))
                self.ids[side] = np.append(self.ids[side], flat[side])
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _words(self, new: list[str]):
        """The words in the order encoded, both sides' ids and how many each word has, and whether both spell it.
        Words are encoded ``JOINED`` at a time, as one text; those that end in white space (which the next word's
        would join) and those of a text that is not spelt are encoded singly."""
        whole = [w for w in new if not w[-1].isspace()]
        single = [w for w in new if w[-1].isspace()]
        texts = ["".join(whole[i:i + JOINED]) for i in range(0, len(whole), JOINED)]
        flat, many = self._ids(texts)
        fine = self._spelt(texts, flat, many)
        length = np.fromiter((len(w.encode()) for w in whole), np.int64, len(whole))
        of = np.arange(len(whole)) // JOINED
        while True:
            end, kept = np.cumsum(length[fine[of]]), of[fine[of]]
            ids = [x[np.repeat(fine, n)] for x, n in zip(flat, many)]
            ends = [np.cumsum(size[x]) for size, x in zip((self.len_a, self.len_b), ids)]
            last = [np.searchsorted(x, end) for x in ends]  # each word's last token
            across = (ends[0][last[0]] != end) | (ends[1][last[1]] != end)  # of a token that the next word shares
            if not across.any():
                break
            fine[kept[across]] = False
        single += [w for w, f in zip(whole, fine[of].tolist()) if not f]
        more, sizes = self._ids(single)
        good = np.append(np.ones(len(end), bool), self._spelt(single, more, sizes))
        return ([w for w, f in zip(whole, fine[of].tolist()) if f] + single, [np.append(x, y) for x, y in zip(ids, more)],
                [np.append(np.diff(x, prepend=-1), y) for x, y in zip(last, sizes)], good)

    def _ids(self, texts: list[str]):
        """Both sides' ids of the texts, and how many each has."""
        got_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B adds a blank itself: in place of a text's first, or to be dropped before a line feed; to an empty text it adds none
        got_b = self.b.encode([w[1:] if w[0] == " " else w for w in texts], num_threads=1) if texts else []
        got_b = [(ids if w[0] == " " else ids[1:]) or [self.blank] for w, ids in zip(texts, got_b)]
        return ([np.fromiter(chain.from_iterable(got), np.int32) for got in (got_a, got_b)],
                [np.fromiter(map(len, got), np.int64, len(got)) for got in (got_a, got_b)])

    def _spelt(self, texts: list[str], flat, sizes) -> np.ndarray:
        """Whether both sides' tokens spell each text."""
        good = np.ones(len(texts), bool)
        if not texts:
            return good
        raw = [w.encode() for w in texts]
        length, whole = np.fromiter(map(len, raw), np.int64, len(raw)), b"".join(raw)
        for table, size, ids, many in zip((self.bytes_a, self.bytes_b), (self.len_a, self.len_b), flat, sizes):
            first = np.cumsum(many) - many
            # as a rule all texts are spelt, which one comparison shows if the texts' ends agree too
            if not (np.array_equal(np.add.reduceat(size[ids], first), length)
                    and b"".join(map(table.__getitem__, ids.tolist())) == whole):
                good &= [b"".join([table[i] for i in ids[a:a + n].tolist()]) == w for a, n, w in zip(first.tolist(), many.tolist(), raw)]
        return good

    def tokens(self, side: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words of that number, and how many each has."""
        lo = self.at[side][words]
        sizes = self.at[side][words + 1] - lo
        place = np.arange(int(sizes.sum())) + np.repeat(lo - (np.cumsum(sizes) - sizes), sizes)
        return self.ids[side][place].astype(np.int64), sizes


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping tokens of frames ``(doc, start)``, both sorted, where both
    sides' tokens cover the same bytes of every document: positions in ``a`` and in ``b``."""
    width = int(max(a["start"].max(), b["start"].max())) + 1
    left = pd.DataFrame({"key": a["doc"].to_numpy() * width + a["start"].to_numpy(), "a": np.arange(len(a))})
    right = pd.DataFrame({"key": b["doc"].to_numpy() * width + b["start"].to_numpy(), "b": np.arange(len(b))})
    # the key holds document and offset, and both sides of a document begin at 0, so the covering token is of the same document
    ab = pd.merge_asof(left, right, on="key", direction="backward")
    right["other"] = right["key"]
    left["at"] = left["key"]
    ba = pd.merge_asof(right, left, on="key", direction="backward")
    ba = ba[ba["at"] != ba["other"]]  # equal starts are links of the first direction already
    i = np.concatenate([ab["a"].to_numpy(), ba["a"].to_numpy()])
    j = np.concatenate([ab["b"].to_numpy(), ba["b"].to_numpy()])
    return i, j


def align(pair: Pair, texts: list[str | None]) -> list[dict]:
    """Per text the numbers, the digest of its groups and its distinct id pairs with counts."""
    none = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "pairs": ((), (), ())}
    out = [dict(none) for _ in texts]
    cut = [words_of(t) if t else [] for t in texts]
    word = pair.encode([w for ws in cut for w in ws])
    sizes = np.array([len(ws) for ws in cut], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    whole = (sizes > 0) & (np.bincount(doc, weights=~pair.good[word], minlength=len(texts)) == 0)
    kept = np.flatnonzero(whole)
    if not len(kept):
        return out
    word, doc = word[whole[doc]], (np.cumsum(whole) - 1)[doc[whole[doc]]]
    ids_a, many_a = pair.tokens(0, word)
    ids_b, many_b = pair.tokens(1, word)
    doc_a, doc_b = np.repeat(doc, many_a), np.repeat(doc, many_b)
    size_a, size_b = np.bincount(doc_a, minlength=len(kept)), np.bincount(doc_b, minlength=len(kept))
    first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b

    def ends(ids, sizes, first, doc):  # byte offsets in the document behind each token
        total = np.cumsum(sizes[ids])
        before = total[first] - sizes[ids[first]]
        return total - before[doc]
    end_a, end_b = ends(ids_a, pair.len_a, first_a, doc_a), ends(ids_b, pair.len_b, first_b, doc_b)
    a = pd.DataFrame({"doc": doc_a, "start": end_a - pair.len_a[ids_a]})
    b = pd.DataFrame({"doc": doc_b, "start": end_b - pair.len_b[ids_b]})
    i, j = overlaps(a, b)
    # equal ends: document and end as one number on both sides
    width = int(max(end_a.max(), end_b.max())) + 1
    key_a, key_b = doc_a * width + end_a, doc_b * width + end_b  # rising, and equal at the last token
    close_a, close_b = key_b[np.searchsorted(key_b, key_a)] == key_a, key_a[np.searchsorted(key_a, key_b)] == key_b
    group_a, group_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b
    many = int(close_a.sum())
    # groups as text: a group's A tokens, then its B tokens; each token carries the sign behind it
    text = np.empty(len(ids_a) + len(ids_b), object)
    in_a, in_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
    text[np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[group_a]] = pair.text_a[ids_a + len(pair.bytes_a) * close_a]
    text[np.arange(len(ids_b)) + np.cumsum(in_a)[group_b]] = pair.text_b[ids_b + len(pair.bytes_b) * close_b]
    links = np.bincount(doc_a[i], minlength=len(kept))
    groups = np.bincount(doc_a[close_a], minlength=len(kept))
    code = (doc_a[i] << 40) | (ids_a[i] << 20) | ids_b[j]
    code, times = np.unique(code, return_counts=True)
    of = np.searchsorted(code >> 40, np.arange(len(kept) + 1))
    for x, k in enumerate(kept.tolist()):
        lo = first_a[x] + first_b[x]
        joined = "".join(text[lo:lo + size_a[x] + size_b[x]].tolist())[:-1]
        own = slice(of[x], of[x + 1])
        out[k] = {"n_a": int(size_a[x]), "n_b": int(size_b[x]), "n_groups": int(groups[x]), "n_links": int(links[x]),
                  "groups_sha256": hashlib.sha256(joined.encode()).hexdigest(),
                  "pairs": ((code[own] >> 20) & 0xFFFFF, code[own] & 0xFFFFF, times[own])}
    return out


_PAIRS: dict[tuple, Pair] = {}


def _paths(a: str | None, b: str | None) -> tuple[str, str]:
    if a and b:
        return a, b
    import public_tokenizers
    return a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")


def _record(rows: list[tuple], got: list[dict]) -> pa.RecordBatch:
    sizes = [len(x["pairs"][0]) for x in got]
    flat = [np.concatenate([np.asarray(x["pairs"][k], np.int64) for x in got]).astype(np.int32) for k in range(3)]
    pairs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.int32()),
                                     pa.StructArray.from_arrays([pa.array(x) for x in flat], ["a", "b", "n"]))
    long = {n: pa.array([x[n] for x in got], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")}
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), *long.values(),
         pa.array([x["groups_sha256"] for x in got], pa.string()), pairs],
        names=["row", "doc_id", *long, "groups_sha256", "pairs"])


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per document with its numbers, the digest of its
    groups and ``pairs``: its distinct linked id pairs and how often each is linked."""
    def run(batches):
        paths = _paths(path_a, path_b)
        if paths not in _PAIRS:
            _PAIRS[paths] = Pair(*paths)
        pair = _PAIRS[paths]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            lo, held = 0, 0
            for k, n in enumerate([*sizes, None]):
                if k > lo and (n is None or held + n > BATCH_BYTES):
                    part = batch.slice(lo, k - lo)
                    rows = list(zip(part.column("row").to_pylist(), part.column("doc_id").to_pylist()))
                    yield _record(rows, align(pair, part.column("text").to_pylist()))
                    lo, held = k, 0
                held += n or 0
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(a, b, count, best)``: links of each id pair in the corpus and whether no other A id
    is linked to the pair's B id more often.  B ids are bounded by the vocabulary, so the maximum
    per B id is a grouped aggregate that is joined back by broadcast."""
    links = aligned.select(F.explode("pairs").alias("p")).select("p.*")
    counts = stage(links.groupBy("a", "b").agg(F.sum("n").alias("count")), "align-pairs")
    top = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(top), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame) -> DataFrame:
    """``aligned`` (written) with ``n_best`` and ``count_sum`` in place of ``pairs``."""
    pairs = stage(pair_counts(aligned), "align-counts")
    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.a", "p.b", "p.n")
    sums = (links.join(pairs, ["a", "b"]).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("long").alias("n_best"),
                 F.sum(F.col("n") * F.col("count")).cast("long").alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (aligned.drop("pairs").join(sums, "row", "left")
            .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers' alignment over every document."""
    aligned = stage(align_documents(table(spark, sf_dir, "documents")), "aligned")
    return score_links(aligned).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
