"""Approximate nearest neighbours by a hierarchical k-means tree (operator 10).

The tree is fitted on a bounded sample (``FIT_ROWS`` rows, the smallest hashes of
vec_id and row): k-means splits a node into up to ``BRANCH`` children until a node holds
``LEAF_ROWS`` sample rows.  Every row is then indexed under the leaf it descends
to.  A query walks the tree best bin first: a priority queue holds the open nodes
by the inner product of query and centroid, the best one is opened next, and
leaves come out in that order.  How many leaves are searched is calibrated: for
``CALIBRATION`` queries the exact neighbours are found by a distributed brute
force over all rows, and visits are widened until ``RECALL`` of them lie in the
leaves visited.  A query whose leaves hold fewer rows than asked for walks on until
they hold enough (rows are counted per leaf).

Nearness is the inner product in double precision; scores returned are computed
row by row on the original vectors, so equal vectors score equal and ties go to
the smaller vec_id.

Scale: the tree (at most ``FIT_ROWS / LEAF_ROWS`` leaves or so, a few MB) is the
only thing every task gets.  Rows and queries meet per leaf; leaves with many
rows or many queries are split into blocks of ``BLOCK`` on either side, so the
largest group is ``BLOCK`` x ``BLOCK`` whatever the data look like.  Each group
returns its best 20 per query, a second step keeps the best 20 of those.

Edge cases: null, zero or non-finite vectors, vectors with a null component or
of another length than most, and null ids take no part; rows that repeat a vec_id are
rows of their own, as queries and as candidates; a product that overflows is infinite
(undefined ones, infinity less infinity, come last); fewer candidates than asked for give them all; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

FIT_ROWS = 20_000
LEAF_ROWS = 64
BRANCH = 16
CALIBRATION = 200
RECALL = 0.98
BLOCK = 4096
K = 20
TIES = 100_000  # candidates whose exact scores are held at once


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, axis=1)
        n = np.bincount(near, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c


class Tree:
    """Nodes by number: ``kids[i]`` numbers of children ([]: a leaf), ``centre[i]``."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS, seed: int = 0):
        rng = np.random.default_rng(seed)
        dim = x.shape[1] if x.ndim == 2 else 0
        self.kids: list[list[int]] = [[]]
        centres = [x.mean(0) if len(x) else np.zeros(dim)]
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf_rows or not np.ptp(x[rows], axis=0).any():
                continue
            # as few children as leave leaves of leaf_rows, so leaves are not slivers
            c = _means(x[rows], min(branch, max(2, -(-len(rows) // leaf_rows))), rng)
            near = np.argmin((c * c).sum(1)[None, :] - 2 * x[rows] @ c.T, axis=1)
            used = np.unique(near)
            if len(used) < 2:
                continue
            for u in used:
                self.kids[node].append(len(self.kids))
                todo.append((len(self.kids), rows[near == u]))
                self.kids.append([])
                centres.append(c[u])
        self.centre = np.asarray(centres)

    def leaves(self) -> int:
        return sum(not k for k in self.kids)

    def descend(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row: the nearest child at every level."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            kids = self.kids[node]
            if not kids:
                leaf[rows] = node
                continue
            c = self.centre[kids]
            near = np.argmin((c * c).sum(1)[None, :] - 2 * x[rows] @ c.T, axis=1)
            todo += [(kid, rows[near == j]) for j, kid in enumerate(kids)]
        return leaf

    def best_bins(self, q: np.ndarray, visits: int, rows: dict[int, int] | None = None, need: int = 0) -> list[int]:
        """The first ``visits`` leaves that a best-bin-first walk reaches, and further
        ones until they hold ``need`` rows (``rows``: rows by leaf)."""
        with np.errstate(over="ignore", invalid="ignore"):
            product = self.centre @ q
        product = np.where(np.isnan(product), -np.inf, product)
        heap, found = [(-float(product[0]), 0)], []
        held = 0
        while heap and (len(found) < visits or held < need):
            _, node = heapq.heappop(heap)
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(heap, (-float(product[kid]), kid))
            else:
                found.append(node)
                held += rows.get(node, 0) if rows else 0
        return found


def _matrix(col) -> np.ndarray:
    return np.vstack(col.to_numpy()).astype(np.float64, copy=False) if len(col) else np.zeros((0, 0))


@np.errstate(over="ignore", invalid="ignore")
def best(q_rows: np.ndarray, q_ids: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """Exact top ``k`` of ``x`` per query row: largest inner product (an undefined one, infinity less
    infinity, last), ties to the smaller id, never the query's own row."""
    parts: list[tuple] = []
    if len(ids):
        rough = q @ x.T
        rough[np.isnan(rough)] = -np.inf
        own = q_rows[:, None] == rows[None, :]
        rough[own] = -np.inf
        if len(ids) > k:
            edge = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
            edge = np.minimum(edge, np.finfo(np.float64).max)  # summed in another order a score may not overflow
            some = rough >= (edge - 1e-9 * np.maximum(1.0, np.abs(edge)))[:, None]
            some[np.isneginf(edge)] = True
        else:
            some = np.ones(rough.shape, bool)
        some &= ~own
        # equal vectors can make many ties: rows are taken in runs of bounded size
        ahead = np.cumsum(some.sum(1))
        lo = 0
        while lo < len(q):
            hi = max(lo + 1, int(np.searchsorted(ahead, (ahead[lo - 1] if lo else 0) + TIES, "right")))
            r, c = np.nonzero(some[lo:hi])
            r += lo
            score = (x[c] * q[r]).sum(axis=1)
            order = np.lexsort((rows[c], ids[c], -score, r))
            r, c, score = r[order], c[order], score[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            keep = place < k
            r, c = r[keep], c[keep]
            parts.append((q_rows[r], q_ids[r], rows[c], ids[c], score[keep]))
            lo = hi
    cols = [np.concatenate([p[j] for p in parts]) if parts else [] for j in range(5)]
    names = ["query_row", "query_id", "row", "vec_id", "score"]
    return pd.DataFrame(dict(zip(names, cols, strict=True))).astype({n: "float64" if n == "score" else "int64" for n in names})


FOUND = "query_row long, query_id long, row long, vec_id long, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each query row (pandas hands undefined scores over as null)."""
    found = found.withColumn("score", F.coalesce("score", F.lit(float("nan"))))
    nearest = Window.partitionBy("query_row").orderBy(F.isnan("score"), F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` -> valid rows as ``array<double>``, each with a number (``row``) of its own."""
    e = F.col("embedding").cast("array<double>")
    ok = (vectors.select("vec_id", e.alias("embedding")).where("vec_id IS NOT NULL AND size(embedding) > 0")
          .where("forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity')) AND exists(embedding, v -> v <> 0)"))
    return ok.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree over a sample of at most ``fit_rows`` rows, the smallest hashes of vec_id and row."""
    n = rows.count()
    mark = F.xxhash64("vec_id", "row")
    share = rows if n <= fit_rows else rows.where(F.pmod(mark, F.lit(1 << 20)) < int((1 << 20) * min(1.0, 1.1 * fit_rows / n + 64 / (1 << 20))))
    got = share.orderBy(mark, "row").limit(fit_rows).select("embedding").toPandas()
    return Tree(_matrix(got["embedding"]), branch, leaf_rows)


def calibrate(rows: DataFrame, queries: DataFrame, tree: Tree, k: int = K, recall: float = RECALL, sample: int = CALIBRATION) -> int:
    """Leaf visits at which ``recall`` of the exact neighbours of a sample of queries are reached."""
    asked = queries.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id", "row").limit(sample).toPandas()
    if not len(asked):
        return 1
    q_rows, q_ids, q = asked["row"].to_numpy(np.int64), asked["vec_id"].to_numpy(np.int64), _matrix(asked["embedding"])

    def brute(batches):
        for pdf in batches:
            yield best(q_rows, q_ids, q, pdf["row"].to_numpy(np.int64), pdf["vec_id"].to_numpy(np.int64), _matrix(pdf["embedding"]), k).merge(pdf[["row", "leaf"]], on="row")
    true = _ranked(rows.mapInPandas(brute, FOUND + ", leaf long"), k).select("query_row", "leaf").toPandas()  # at most sample * k rows
    order = {int(i): {leaf: n for n, leaf in enumerate(tree.best_bins(v, len(tree.kids)))} for i, v in zip(q_rows, q, strict=True)}
    if not len(true):
        return 1
    place = np.sort([order[a][b] for a, b in zip(true["query_row"].tolist(), true["leaf"].tolist(), strict=True)])
    return int(place[min(len(place) - 1, int(np.ceil(recall * len(place))) - 1)]) + 1


def search(vectors: DataFrame, is_query=None, k: int = K, recall: float = RECALL) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> ``(query_id, rank, vec_id, score)``: the
    ``k`` nearest found of every row for which ``is_query`` (a Column over vec_id)
    holds (none given: every row)."""
    rows = stage(usable(vectors), "vectors")
    dims = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("embedding") == dims["d"])
    tree = fit(rows)

    def place(batches):
        for pdf in batches:
            yield pdf.assign(leaf=tree.descend(_matrix(pdf["embedding"])) if len(pdf) else np.zeros(0, np.int64))
    index = stage(rows.mapInPandas(place, "row long, vec_id long, embedding array<double>, leaf long"), "leaves")
    queries = index.where(is_query if is_query is not None else F.lit(True)).select("row", "vec_id", "embedding")
    visits = calibrate(index, queries, tree, k, recall)
    rows_of = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # one number per leaf of the tree

    def route(batches):
        for pdf in batches:
            walks = [tree.best_bins(v, visits, rows_of, k + 1) for v in _matrix(pdf["embedding"])]
            yield pd.DataFrame({"query_row": pdf["row"].to_numpy(np.int64), "leaf": walks})
    routed = stage(queries.mapInPandas(route, "query_row long, leaf array<long>").select("query_row", F.explode("leaf").alias("leaf")), "routes")
    # blocks of rows and of queries per leaf
    size = index.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
    asked = routed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nq"))
    blocks = stage(size.join(asked, "leaf"), "leaf-blocks")  # one row per leaf
    one = F.pmod(F.xxhash64("row"), F.col("nb")).cast("int")
    left = (index.join(blocks, "leaf").select("leaf", one.alias("b"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("c"), "row", "vec_id", "embedding"))
    two = F.pmod(F.xxhash64("query_row"), F.col("nq")).cast("int")
    asked_rows = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    right = (routed.join(asked_rows, "query_row").join(blocks, "leaf")
             .select("leaf", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"), two.alias("c"), "query_row", "query_id", "q"))

    def meet(rows_, asked_):
        return best(asked_["query_row"].to_numpy(np.int64), asked_["query_id"].to_numpy(np.int64), _matrix(asked_["q"]),
                    rows_["row"].to_numpy(np.int64), rows_["vec_id"].to_numpy(np.int64), _matrix(rows_["embedding"]), k)
    found = left.groupBy("leaf", "b", "c").cogroup(right.groupBy(right["leaf"], right["b"], right["c"])).applyInPandas(meet, FOUND)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
