"""N-gram Jaccard join by chosen paths (operator 5).

Finds all documents whose sets of 5-word shingles have Jaccard similarity of at
least 0.8, with exact link counts and classes (connected documents).

Chosen path: in each run a set is put under a path of sampled tokens; a token of
the set extends a path when the hash of (path, token) falls below 1 / (t * |set|),
so similar sets, sharing most tokens, sooner or later share a path, and sets that
share little part ways.  A path shared by at most ``SMALL`` sets is compared by
brute force; a path shared by more is split once more on a further sampled token
of each set, and what still is together is compared in blocks of ``BLOCK`` x
``BLOCK``.  A pair of similarity t survives one split with probability
1 - exp(-2 / (1 + t)) or more and two with ``_survive``; runs are repeated until
the chance to miss it in all of them is below 1 - ``RECALL``.

Comparison in a path uses sketches (one-permutation minhash, 64 bins of a byte)
with a margin below the threshold; it only links sets into candidate clusters.
Every cluster then gets its texts once, and all pairs in it are compared exactly
on whole shingle sets, so counts do not depend on how a pair was found and no
pair is emitted: a task returns per member the number of its links and one link
towards each connected part.

Scale: equal texts are one class with a count before anything else.  One pass over
the texts yields paths and sketches (about 500 bytes a document); only clusters'
texts move.  Paths and clusters of any size are cut into block pairs, so no task
holds more than two blocks.  Components are found by star rounds on tables.

Edge cases: null or wordless texts have no shingles, link to nothing (not even
to each other) and are their own class; a text of fewer than five words is one
shingle; repeated rows are copies of one text; a class is named by the smallest
doc_id in it (null ids aside); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, shuffle_partitions, stage, table
from .components import components
from .shingles import SHINGLE, mix, shingle_sets

THRESHOLD = 0.8
RECALL = 0.999
SMALL = 64
BLOCK = 1024
MARGIN = 0.2  # sketches: four standard deviations
BINS = 64

_U = np.uint64


def _survive(t: float, depth: int) -> float:
    """Chance that two sets of similarity ``t`` share a path of ``depth`` tokens in
    one run: a branching process with Poisson(s / t) children, s the shared share."""
    shared, q = 2 * t / (1 + t), 0.0
    for _ in range(depth):
        q = math.exp(-shared / t * (1 - q))
    return 1 - q


def runs_needed(t: float = THRESHOLD, recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - _survive(t, 2)))


def _sketch(s: np.ndarray) -> bytes:
    """64 bins by the top six bits; a bin keeps one byte of its minimum, 0 if empty."""
    low = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    bins = (s >> _U(58)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))  # s is sorted: the first of a bin is its minimum
    low[bins[first]] = s[first]
    out = (mix(low) % _U(255) + _U(1)).astype(np.uint8)
    full = np.zeros(BINS, bool)
    full[bins[first]] = True
    out[~full] = 0
    return out.tobytes()


def _paths(s: np.ndarray, run_seeds: np.ndarray, t: float) -> tuple[list[int], list[list[int]]]:
    """First tokens chosen in each run, and the second tokens behind each, as path keys."""
    limit = _U(min(2**64 - 1, int(2**64 / (t * len(s)))))
    r, k = np.nonzero(mix(s[None, :] ^ run_seeds[:, None]) < limit)
    if not len(r):
        return [], []
    keys = mix(s[k] + run_seeds[r] * _U(3))
    r2, k2 = np.nonzero(mix(s[None, :] ^ keys[:, None]) < limit)
    kids = mix(s[k2] * _U(5) + keys[r2])
    cut = np.searchsorted(r2, np.arange(len(keys) + 1))
    return keys.view(np.int64).tolist(), [kids[a:b].view(np.int64).tolist() for a, b in zip(cut, cut[1:], strict=False)]


def signatures(classes: DataFrame, t: float, runs: int, shingle: int = SHINGLE) -> DataFrame:
    """``(cls, text)`` -> ``(cls, n, sketch, paths)``."""
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64) * _U(0xA24BAED4963EE407))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for cls, s in zip(pdf["cls"], shingle_sets(pdf["text"].tolist(), shingle), strict=True):
                if len(s):
                    keys, kids = _paths(s, seeds, t)
                    rows.append((cls, len(s), _sketch(s), keys, kids))
            yield pd.DataFrame(rows, columns=["cls", "n", "sketch", "keys", "kids"])
    return classes.mapInPandas(run, "cls string, n int, sketch binary, keys array<long>, kids array<array<long>>")


def block_pairs(rows: DataFrame, key: str, size: str, node: str, block: int = BLOCK) -> DataFrame:
    """Each row once per pair of blocks it belongs to: columns ``bi <= bj`` and
    ``side`` (its own block).  A group of at most ``block`` rows is one pair (0, 0)."""
    nb = F.ceil(F.col(size) / block).cast("int")
    rows = rows.withColumn("nb", nb).withColumn("side", F.pmod(F.xxhash64(node, F.lit(11)), F.col("nb")).cast("int"))
    with_ = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(F.least(F.col("side"), o).alias("bi"), F.greatest(F.col("side"), o).alias("bj")))
    return rows.withColumn("p", F.explode(with_)).select("*", "p.bi", "p.bj").drop("p", "nb")


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``by`` -> frames of whole groups, several at a time."""
    left = None
    for pdf in batches:
        if not len(pdf):
            continue
        if left is not None and len(left):
            pdf = pd.concat([left, pdf], ignore_index=True)
        last = np.ones(len(pdf), bool)
        for c in by:
            last &= (pdf[c] == pdf[c].iloc[-1]).to_numpy()
        left = pdf[last]
        done = pdf[~last]
        if len(done):
            yield done.reset_index(drop=True)
    if left is not None and len(left):
        yield left.reset_index(drop=True)


def _bounds(pdf: pd.DataFrame, by: list[str]) -> np.ndarray:
    new = np.zeros(len(pdf), bool)
    new[0] = True
    for c in by:
        v = pdf[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(pdf))


class _Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _forest(similar: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a boolean matrix."""
    sets, out = _Sets(len(similar)), []
    for i, j in zip(*np.nonzero(np.triu(similar, 1)), strict=True):
        if sets.join(int(i), int(j)):
            out.append((int(i), int(j)))
    return out


def _alike(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, t: float) -> np.ndarray:
    """Sketches (rows of 64 bytes) that may reach ``t``: sizes allow it and so do the bins."""
    out = np.zeros((len(a), len(b)), bool)
    for i in range(len(a)):
        used = (a[i] != 0) | (b != 0)
        same = (a[i] == b) & (b != 0)
        out[i] = same.sum(1) >= (t - MARGIN) * used.sum(1)
    return out & (np.minimum.outer(na, nb) >= t * np.maximum.outer(na, nb) - 1e-9)


def candidate_links(members: DataFrame, t: float) -> DataFrame:
    """``members(path, cls, n, sketch, m)``, m the path's size -> links ``(a, b)``
    that span the members whose sketches are alike."""
    by = ["path", "bi", "bj"]
    rows = block_pairs(members, "path", "m", "cls")
    rows = rows.repartition(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by, "cls")

    def run(batches):
        for pdf in _groups(batches, by):
            links: list[tuple[str, str]] = []
            cls, n, side = pdf["cls"].to_numpy(), pdf["n"].to_numpy(np.int64), pdf["side"].to_numpy()
            sk = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(-1, BINS)
            cut = _bounds(pdf, by)
            size = np.diff(cut)
            # groups of two, by far the most, at once
            two = cut[:-1][size == 2]
            a, b = two, two + 1
            used = ((sk[a] != 0) | (sk[b] != 0)).sum(1)
            ok = ((sk[a] == sk[b]) & (sk[b] != 0)).sum(1) >= (t - MARGIN) * used
            ok &= np.minimum(n[a], n[b]) >= t * np.maximum(n[a], n[b]) - 1e-9
            links += zip(cls[a[ok]], cls[b[ok]], strict=True)
            for g in np.flatnonzero(size > 2):
                s = slice(cut[g], cut[g + 1])
                own = np.arange(cut[g], cut[g + 1])
                near = _alike(sk[s], n[s], sk[s], n[s], t)
                if pdf["bi"].iat[cut[g]] != pdf["bj"].iat[cut[g]]:
                    near &= side[s][:, None] != side[s][None, :]
                links += [(cls[own[i]], cls[own[j]]) for i, j in _forest(near)]
            yield pd.DataFrame(links, columns=["a", "b"])
    return rows.mapInPandas(run, "a string, b string").distinct()


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of incidence columns."""
    m = len(sets)
    value, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    keep = count[inverse] > 1
    number = np.cumsum(count > 1) - 1
    col, row = number[inverse[keep]], row[keep]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    out = np.zeros((m, m), np.float32)
    total = int((count > 1).sum())
    for lo in range(0, total, 4096):
        a, b = np.searchsorted(col, [lo, lo + 4096])
        x = np.zeros((m, min(4096, total - lo)), np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        out += x @ x.T
    return out


def exact_links(clusters: DataFrame, t: float, shingle: int = SHINGLE) -> DataFrame:
    """``clusters(cluster, m, cls, text, copies)`` -> per class and block pair the
    documents linked to it and one link into each connected part: ``(cls, peer, links)``."""
    by = ["cluster", "bi", "bj"]
    rows = block_pairs(clusters, "cluster", "m", "cls")
    rows = rows.repartition(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by, "cls")

    def run(batches):
        for pdf in _groups(batches, by):
            out: list[tuple] = []
            cut = _bounds(pdf, by)
            for lo, hi in zip(cut, cut[1:], strict=False):
                part = pdf.iloc[lo:hi]
                sets = shingle_sets(part["text"].tolist(), shingle)
                n = np.asarray([len(s) for s in sets], np.float64)
                both = _shared(sets).astype(np.float64)
                near = both >= t * (n[:, None] + n[None, :] - both) - 1e-9
                np.fill_diagonal(near, False)
                if part["bi"].iat[0] != part["bj"].iat[0]:
                    side = part["side"].to_numpy()
                    near &= side[:, None] != side[None, :]
                cls = part["cls"].to_numpy()
                links = near.astype(np.float64) @ part["copies"].to_numpy(np.float64)
                out += [(c, None, int(k)) for c, k in zip(cls, links, strict=True) if k]
                out += [(cls[i], cls[j], 0) for i, j in _forest(near)]
            yield pd.DataFrame(out, columns=["cls", "peer", "links"]).astype({"links": "int64"})
    return rows.mapInPandas(run, "cls string, peer string, links long")


def near_classes(docs: DataFrame, t: float = THRESHOLD, recall: float = RECALL, small: int = SMALL,
                 shingle: int = SHINGLE) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per class of equal texts with words:
    ``(cls, copies, first_id, links, component, class_id)``; ``cls`` is the text's md5, ``links`` the
    number of documents with another text at similarity ``t`` or more."""
    with scratch(docs.sparkSession):
        named = _named(docs, t, recall, small, shingle)
    ids = named.groupBy("component").agg(F.min("first_id").alias("class_id"))
    return named.join(ids, "component").select("cls", "copies", "first_id", "links", "component", "class_id")


def _named(docs: DataFrame, t: float, recall: float, small: int, shingle: int) -> DataFrame:
    """``near_classes`` without ``class_id``, written."""
    texts = docs.select("doc_id", F.md5("text").alias("cls"), "text").where("text IS NOT NULL")
    classes = texts.groupBy("cls").agg(F.first("text").alias("text"), F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
    known = stage(texts.groupBy("cls").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")), "classes")
    sig = stage(signatures(classes.select("cls", "text"), t, runs_needed(t, recall), shingle), "paths")
    # paths of the first split; crowded ones are split again
    one = sig.select("cls", "n", "sketch", F.explode(F.arrays_zip("keys", "kids")).alias("p")).select("cls", "n", "sketch", F.col("p.keys").alias("path"), F.col("p.kids").alias("kids"))
    sizes = sig.select(F.explode("keys").alias("path")).groupBy("path").agg(F.count("*").alias("m")).where("m > 1")
    met = one.join(sizes, "path")
    leaves = met.where(F.col("m") <= small).select("path", "cls", "n", "sketch", "m")
    crowd = stage(met.where(F.col("m") > small).select("cls", "n", "sketch", F.explode("kids").alias("path")), "crowds")
    again = crowd.groupBy("path").agg(F.count("*").alias("m")).where("m > 1")
    leaves = leaves.unionByName(crowd.join(again, "path").select("path", "cls", "n", "sketch", "m"))
    groups = components(candidate_links(leaves, t)).select(F.col("node").alias("cls"), F.col("component").alias("cluster"))
    sized = groups.join(groups.groupBy("cluster").agg(F.count("*").alias("m")), "cluster")
    full = sized.join(classes.select("cls", "text", "copies"), "cls")
    found = stage(exact_links(full, t, shingle), "exact-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(found.where("peer IS NOT NULL").select(F.col("cls").alias("a"), F.col("peer").alias("b")))
    per = (known.join(links, "cls", "left").join(parts.withColumnRenamed("node", "cls"), "cls", "left")
           .select("cls", "copies", "first_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "cls").alias("component")))
    return stage(per.join(sig.select("cls").withColumn("worded", F.lit(True)), "cls"), "near", outer=True)


def keep_one(docs: DataFrame, t: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class of near duplicates: the smallest
    doc_id's (null last; of equal rows one, by all orderable columns).  Wordless
    documents stay.  Columns as given."""
    cols = docs.columns
    near = near_classes(docs, t, recall)
    best = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "cls"))
    keep = near.groupBy("component").agg(best.alias("b")).select(F.col("b.cls").alias("k_cls"), F.col("b.first_id").alias("k_id"))
    rows = docs.select(F.struct(*cols).alias("__row"), F.col("doc_id").alias("__id"), F.md5("text").alias("__cls"))
    order = F.struct(*[F.col("__row")[f.name].alias(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    one = (rows.join(keep, F.expr("__cls = k_cls AND __id <=> k_id")).groupBy("__cls").agg(F.min_by("__row", order).alias("__row")))
    bare = rows.join(near.select(F.col("cls").alias("k_cls")), F.expr("__cls = k_cls"), "left_anti")
    return one.select("__row").unionByName(bare.select("__row")).select(*[F.col("__row")[c].alias(c) for c in cols])


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of the connected
    class), links (other documents at similarity 0.8 or more, copies included)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    near = near_classes(docs)
    return (docs.select("doc_id", F.md5("text").alias("cls")).join(near, "cls", "left")
            .select("doc_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("links")))


OP5_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, md5(text) AS cls, regexp_extract_all(lower(text), '[0-9a-z_\x{80}-\x{10FFFF}]+') AS w FROM documents),
s AS (SELECT DISTINCT cls, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
      FROM t WHERE len(w) > 0),
n AS (SELECT cls, count(*) AS n FROM s GROUP BY cls),
p AS (SELECT a.cls AS a, b.cls AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.cls <> b.cls GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.cls = a JOIN n y ON y.cls = b WHERE k >= 0.8 * (x.n + y.n - k) - 1e-9),
c AS (SELECT cls, count(*) AS copies, min(doc_id) AS first_id FROM t GROUP BY cls),
r AS (SELECT cls AS node, cls AS seen FROM n UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
m AS (SELECT node, min(first_id) AS class_id FROM r JOIN c ON c.cls = r.seen GROUP BY node),
d AS (SELECT a, sum(copies)::BIGINT AS links FROM l JOIN c ON c.cls = l.b GROUP BY a)
SELECT t.doc_id, CASE WHEN n.cls IS NULL THEN t.doc_id ELSE m.class_id END AS class_id,
       (CASE WHEN n.cls IS NULL THEN 0 ELSE coalesce(d.links, 0) + c.copies - 1 END)::BIGINT AS links
FROM t LEFT JOIN n ON n.cls = t.cls LEFT JOIN m ON m.node = t.cls LEFT JOIN d ON d.a = t.cls LEFT JOIN c ON c.cls = t.cls
"""
