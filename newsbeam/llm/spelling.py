"""Spelling variants by FM-index search schemes (operator 12).

Words are counted over whole texts; two words are near if one inserted, deleted or
replaced character turns one into the other.  One error lies either in a word's second
half, then the first half of both words is equal, or in its first half.  So every word is
searched by two schemes: its first half exactly from the left, then across the second with
one error; and its second half exactly from the right, then across the first with one
error.  Both run on an FM-index of the delimited vocabulary: a pattern is a suffix-rank
interval, one more character to the right is a backward step in the index of the reversed
words, one more to the left a step in the index of the words.  The second scheme reports
only pairs whose first halves differ, so no pair is found twice.

Scale: words that share a half of three characters or more share its first (last) three, so
by these the vocabulary is dealt to bins, each with an index of its own.  A bin is meant to
hold ``INDEX_CHARS`` characters; one that holds more (many words with one beginning) is cut
into parts, and each part's index is searched by each part's words, so no task holds more
than two parts and no pair is lost.  A word comes back with its number of near words and its
best one, not with all of them.  Counting has a map-side step; chains of forms are followed
by pointer doubling, which ends after a few rounds because n grows tenfold per step.

Edge cases: a null text has no words, a null id is written ``null`` in the digest; repeated
rows count as often as they stand there; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage, table

MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10  # a form is at least so many times as frequent
MISSPELT = 31  # a word of a document whose digest this divides loses a character
INDEX_CHARS = 1 << 19
QUERY_CHARS = 1 << 17
HELD_WORDS = 200_000  # words counted in a Python worker before they are handed on
SLICE = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def _slices(text: str):
    """``text`` in slices of about ``SLICE`` characters that cut no run."""
    lo = 0
    while lo < len(text):
        hi = lo + SLICE
        if hi < len(text):
            run = _RUN.match(text, hi)
            hi = run.end() if run else hi
        yield text[lo:hi]
        lo = hi


def document_words(doc_id, text: str | None) -> Counter:
    """The words of one document with their counts, lower-cased and some misspelt."""
    runs: Counter = Counter()
    for part in _slices(text or ""):
        runs.update(_RUN.findall(part.translate(_LOWER)))
    out: Counter = Counter()
    seed = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    for word, n in runs.items():
        h = zlib.crc32(word.encode(), seed)
        if h % MISSPELT == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1:]
        if len(word) >= MIN_LENGTH:
            out[word] += n
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(word, n)`` of all words frequent and long enough."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                held.update(document_words(d, t))
                if len(held) > HELD_WORDS:
                    yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters one behind the other, and where each word begins."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


class Index:
    """FM-index of distinct words, each delimited; patterns grow to the right.

    The text is the reversed words in their order with a delimiter before each, so a
    backward step appends a character to the pattern.  Delimiters are ordered as the words
    behind them, so the rank of a word's delimiter is the word's number."""

    def __init__(self, words: list[str]):
        flipped = sorted(w[::-1] for w in words)
        self.words = [w[::-1] for w in flipped]
        flat, at = _codes(flipped)
        self.alphabet, code = np.unique(flat, return_inverse=True)
        k = len(flipped)
        n = len(flat) + k + 1
        text = np.zeros(n, np.int64)  # 0 is the delimiter
        body = np.ones(n, bool)
        body[at + np.arange(k + 1)] = False
        text[body] = code + 1
        rank = text + k  # delimiters by their words; the last is followed by the first
        rank[at[:-1] + np.arange(k)] = np.arange(1, k + 1)
        rank[n - 1] = 0
        h = 1
        while True:  # suffix ranks by doubling
            key = rank * (n + len(self.alphabet) + 1) + np.roll(rank, -h)
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            if rank[order[-1]] == n - 1:
                break
            h *= 2
        self.n = n
        self.last = text[order - 1]  # the character before each suffix (the transform)
        self.keys = np.sort(self.last * n + np.arange(n))
        self.start = (0, k + 1)

    def code(self, flat: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == flat, at + 1, len(self.alphabet) + 1)

    def step(self, c, lo, hi):
        """Intervals of the patterns with ``c`` appended."""
        return np.searchsorted(self.keys, c * self.n + lo), np.searchsorted(self.keys, c * self.n + hi)

    def branches(self, lo, hi):
        """``(state, character)`` of every character that can be appended."""
        sigma = len(self.alphabet)
        wide = hi - lo > sigma
        state = np.flatnonzero(wide)
        every = np.repeat(state, sigma), np.tile(np.arange(1, sigma + 1), len(state))
        state = np.flatnonzero(~wide)
        sizes = (hi - lo)[state]
        owner = np.repeat(state, sizes)
        row = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[owner]
        some = np.unique(owner * (sigma + 2) + self.last[row])
        some = some[some % (sigma + 2) > 0]
        return np.concatenate([every[0], some // (sigma + 2)]), np.concatenate([every[1], some % (sigma + 2)])


def search(index: Index, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs ``(query, word of the index)`` with one error behind the query's first
    ``exact`` characters, each once."""
    flat, at = _codes(queries)
    code, size = np.concatenate([index.code(flat), [0]]), np.diff(at)
    at = at[:-1]
    found_q, found_w = [], []
    q = np.arange(len(queries))  # patterns without an error so far
    lo, hi = np.full(len(q), index.start[0]), np.full(len(q), index.start[1])
    pool = [np.empty(0, np.int64)] * 4  # with one: query, interval, characters matched
    t = 0
    while len(q) or len(pool[0]):
        if len(q):
            due = np.flatnonzero(t >= exact[q])
            b, c = index.branches(lo[due], hi[due])
            b = due[b]
            inside, own = t < size[q[b]], code[at[q[b]] + np.minimum(t, size[q[b]] - 1)]
            other = ~inside | (c != own)  # a second copy of a character is put behind the first
            b, c, inside = b[other], c[other], inside[other]
            l2, h2 = index.step(c, lo[b], hi[b])
            some = l2 < h2
            b, l2, h2, inside = b[some], l2[some], h2[some], inside[some]
            drop = due[t < size[q[due]]]  # the last of equal characters in a row is the one left out
            here = at[q[drop]] + t
            drop = drop[(t + 1 == size[q[drop]]) | (code[here] != code[here + 1])]
            pool = [np.concatenate(x) for x in zip(
                pool, (q[b], l2, h2, np.full(len(b), t)),  # inserted
                (q[b[inside]], l2[inside], h2[inside], np.full(int(inside.sum()), t + 1)),  # replaced
                (q[drop], lo[drop], hi[drop], np.full(len(drop), t + 1)))]  # left out
            go = t < size[q]
            q, lo, hi = q[go], lo[go], hi[go]
            lo, hi = index.step(code[at[q] + t], lo, hi)
            go = lo < hi
            q, lo, hi = q[go], lo[go], hi[go]
            t += 1
        pq, pl, ph, done = pool
        ended = done == size[pq]
        pl, ph = index.step(np.where(ended, 0, code[at[pq] + np.minimum(done, size[pq] - 1)]), pl, ph)
        some = pl < ph
        found_q.append(pq[some & ended])
        found_w.append(pl[some & ended] - 1)
        go = some & ~ended
        pool = [pq[go], pl[go], ph[go], done[go] + 1]
    return np.concatenate(found_q), np.concatenate(found_w)


def near_in_group(side: str, indexed: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Per asked word the number of near words of one scheme among the indexed ones and the
    most frequent of them (the first in code-point order of equals)."""
    flip = (lambda w: w[::-1]) if side == "last" else (lambda w: w)
    index = Index([flip(w) for w in indexed["word"]])
    counts = dict(zip(indexed["word"], indexed["n"]))
    words = [flip(w) for w in index.words]
    n = np.array([counts[w] for w in words], np.int64)
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    asked = sorted(asked["word"], key=len)
    out, lo = [], 0
    while lo < len(asked):
        hi, chars = lo, 0
        while hi < len(asked) and (hi == lo or chars + len(asked[hi]) <= QUERY_CHARS):
            chars += len(asked[hi])
            hi += 1
        block = asked[lo:hi]
        lo = hi
        half = np.array([len(w) // 2 for w in block])
        size = np.array([len(w) for w in block])
        q, w = search(index, [flip(x) for x in block], size - half if side == "last" else half)
        if side == "last":  # equal first halves are the other scheme's
            new = np.array([words[b][:half[a]] != block[a][:half[a]] for a, b in zip(q.tolist(), w.tolist())], bool)
            q, w = (q[new], w[new]) if len(q) else (q, w)
        if len(q):
            by = np.lexsort((order[w], -n[w], q))
            q, w = q[by], w[by]
            first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
            out.append(pd.DataFrame({"word": [block[a] for a in q[first]], "n_near": np.diff(np.append(first, len(q))),
                                     "best": [words[b] for b in w[first]], "best_n": n[w[first]]}))
    return pd.concat(out) if out else pd.DataFrame({"word": [], "n_near": [], "best": [], "best_n": []})


def near_words(vocabulary: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """``vocabulary(word, n)``, distinct words -> ``(word, n_near, best, best_n)`` of every word with near words."""
    size = vocabulary.agg(F.sum(F.length("word"))).first()[0] or 0
    bins = max(1, math.ceil(size / index_chars))
    ends = vocabulary.select("word", "n", F.explode(F.array(
        F.struct(F.lit("first").alias("side"), F.substring("word", 1, 3).alias("end")),
        F.struct(F.lit("last").alias("side"), F.substring("word", -3, 3).alias("end")))).alias("e"))
    dealt = ends.select("word", "n", "e.side", F.pmod(F.xxhash64("e.end"), F.lit(bins)).alias("bin"))
    # one row per side and bin, as many as the vocabulary has parts
    parts = dealt.groupBy("side", "bin").agg(F.ceil(F.sum(F.length("word")) / (2 * index_chars)).alias("parts"))
    own = dealt.join(parts, ["side", "bin"]).withColumn("own", F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    as_index = own.select("side", "bin", "word", "n", F.col("own").alias("i"), each.alias("j"), F.lit(True).alias("index"))
    as_query = own.select("side", "bin", "word", "n", each.alias("i"), F.col("own").alias("j"), F.lit(False).alias("index"))

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        indexed, asked = rows[rows["index"]], rows[~rows["index"]]
        if not len(indexed) or not len(asked):
            return pd.DataFrame({"word": [], "n_near": [], "best": [], "best_n": []})
        return near_in_group(key[0], indexed, asked)
    # a number of its own, so that small bins are not put into few tasks: the search is the work, not the bytes
    dealt = as_index.unionByName(as_query).repartition(max(2 * bins, shuffle_partitions(vocabulary.sparkSession)), "side", "bin", "i", "j")
    found = dealt.groupBy("side", "bin", "i", "j").applyInPandas(run, "word string, n_near long, best string, best_n long")
    first = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word"))).alias("first")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
            .select("word", "n_near", F.col("first.word").alias("best"), (-F.col("first.minus")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``forms(word, form)`` -> ``(word, root)``: the last of each chain."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        joined = now.join(ahead, F.col("root") == F.col("__at"), "left")
        now = stage(joined.select("word", F.coalesce("__next", "root").alias("root"),
                                  F.col("__next").isNotNull().alias("moved")), "roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """All words of ``docs(doc_id, text)`` with their spelling forms."""
    vocabulary = stage(count_words(docs), "vocabulary")
    near = near_words(vocabulary, index_chars)
    formed = F.col("best_n") >= TIMES * F.col("n")
    words = stage(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    last = roots(words.where("form IS NOT NULL"))
    return words.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants over every document."""
    return variants(table(spark, sf_dir, "documents"))
