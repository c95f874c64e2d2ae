"""Toxicity grades by cumulative-link ordinal regression (operator 1).

Model: P(grade >= k | x) = sigmoid(w.x - theta_k) with one weight vector ``w``
shared by all thresholds theta_1 < ... < theta_K.  Features are sparse: the
distinct lower-cased words of the text and their first 3, 4, 5 and 6 letters (so
an inflected form counts even if it is new), each with the logarithm of the
number of distinct words that have it, and the number of distinct words.  ``w`` has an L1 penalty and is
fitted by proximal gradient steps.  Output: the probability of each grade, the
expected severity (the sum of P(grade >= k)) and the most probable grade; a
document is rejected when P(grade >= 1) reaches ``REJECT``.

The ``labels`` table only says toxic or not, so ``severity_labels`` turns that
into ordered grades: 0 for clean rows; for toxic rows 1, 2 or 3 by how many
distinct words of theirs are marked (seen in toxic rows only, or almost).

Fit: on a bounded sample, at most ``MAX_ROWS`` labelled rows of each class (the
smallest hashes of doc_id), and at most ``MAX_FEATURES`` features (largest
chi-square).  Counting features over the sample is a Spark job; only the chosen
features of the sampled rows reach the driver.  Scoring reads every text whole,
in one pass without a shuffle.

Edge cases: null or wordless text scores as a text without features; a table
without toxic or clean labels gives a model that calls everything clean;
contradicting labels of one document count as toxic; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

MAX_ROWS = 4096
MAX_FEATURES = 4096
MIN_ROWS = 3
PREFIXES = (3, 4, 5, 6)
GRADES = 3
REJECT = 0.5
WORD_CACHE = 300_000
WORD_PENALTY = 10.0

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return ["=" + word] + [f"{n}{word[:n]}" for n in PREFIXES if len(word) > n]


def text_features(text: str | None) -> dict[str, int]:
    """Feature -> number of distinct words of the text that have it; ``#`` counts them all."""
    return _counts(set(_WORD.findall((text or "").lower())))


def value(count):
    """What a count enters the predictor with."""
    return np.log2(1.0 + np.asarray(count, float))


def _sigmoid(z):
    return 0.5 * (1.0 + np.tanh(0.5 * z))


@dataclass
class OrdinalModel:
    """Shared weights by feature and ascending thresholds."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (10.0, 11.0, 12.0)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k), one column per threshold."""
        return _sigmoid(np.asarray(score, float)[:, None] - np.asarray(self.thresholds)[None, :])


def fit_ordinal(rows: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, row_weight: np.ndarray,
                penalty: np.ndarray, k: int, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Proximal gradient with momentum on the weighted negative log-likelihood.
    ``rows`` and ``values`` hold the feature numbers and values of every row,
    ``penalty`` the L1 penalty of every feature."""
    n, n_features = len(rows), len(penalty)
    at = np.concatenate(rows).astype(np.int64)
    x = np.concatenate(values)
    of = np.repeat(np.arange(n), [len(r) for r in rows])
    cw = row_weight / row_weight.sum()
    share = np.clip([cw[grades >= j].sum() for j in range(1, k + 1)], 1e-3, 1 - 1e-3)
    logit = np.log(share / (1 - share))
    gap = np.concatenate([[-logit[0]], np.log(np.maximum(1e-2, -np.diff(logit)))])
    scale = 1.0 / np.sqrt(np.maximum(np.bincount(at, weights=cw[of] * x * x, minlength=n_features), 1e-4))  # step by how often a feature occurs
    vw, pw, pg = np.zeros(n_features), np.zeros(n_features), gap.copy()
    vg, lr = gap.copy(), 0.35
    for r in range(rounds):
        theta = vg[0] + np.concatenate([[0.0], np.cumsum(np.exp(vg[1:]))])
        eta = np.bincount(of, weights=vw[at] * x, minlength=n)
        a = _sigmoid(eta - np.concatenate([[-np.inf], theta])[grades])  # P(y >= g)
        b = _sigmoid(eta - np.concatenate([theta, [np.inf]])[grades])   # P(y >= g + 1)
        p = np.maximum(a - b, 1e-12)
        da, db = a * (1 - a), b * (1 - b)
        d_eta = -(da - db) / p * cw
        g_theta = np.zeros(k)
        np.add.at(g_theta, grades[grades > 0] - 1, (da / p * cw)[grades > 0])
        np.add.at(g_theta, grades[grades < k], (-db / p * cw)[grades < k])
        g_w = np.bincount(at, weights=d_eta[of] * x, minlength=n_features)
        back = np.cumsum(g_theta[::-1])[::-1]
        g_gap = np.concatenate([back[:1], back[1:] * np.exp(vg[1:])])
        step = lr * scale
        nw = vw - step * g_w
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0.0)
        ng = vg - lr * np.clip(g_gap, -1, 1)
        m = r / (r + 3.0)
        vw, vg = nw + m * (nw - pw), ng + m * (ng - pg)
        pw, pg = nw, ng
    return pw, pg[0] + np.concatenate([[0.0], np.cumsum(np.exp(pg[1:]))])


def penalties(features: list[str], l1: float = 2e-4) -> np.ndarray:
    """Whole words pay ``WORD_PENALTY`` times as much as prefixes, the length feature nothing."""
    return np.asarray([0.0 if f == "#" else l1 * WORD_PENALTY if f[0] == "=" else l1 for f in features])


def one_label(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def sample_labels(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` doc_ids of each class, the smallest hashes: ``(doc_id, toxic)``."""
    one = one_label(labels)
    h = F.xxhash64("doc_id")
    return one.where("toxic > 0").orderBy(h).limit(max_rows).unionByName(one.where("toxic <= 0").orderBy(h).limit(max_rows))


def _features(batches):
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"],
                            "words": [sorted(set(_WORD.findall((t or "").lower()))) for t in pdf["text"]]})


def _counts(words) -> dict[str, int]:
    out = Counter(f for w in words for f in word_features(w))
    out["#"] = len(words)
    return out


def _explode(batches):
    for pdf in batches:
        seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for t, ws in zip(pdf["toxic"], pdf["words"], strict=True):
            seen[t > 0].update(_counts(ws).keys())
        rows = [(f, n if t else 0, 0 if t else n) for t in seen for f, n in seen[t].items()]
        yield pd.DataFrame(rows, columns=["f", "a", "b"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit on the labelled rows of ``docs(doc_id, text)`` within the bounds."""
    # of several documents with one id one is read
    text = docs.select("doc_id", "text").join(sample_labels(labels, max_rows), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    feats = stage(text.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
                  .mapInPandas(_features, "doc_id long, toxic int, words array<string>"), "tox-words")
    sizes = {bool(r["t"]): r["n"] for r in feats.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    nt, nc = sizes.get(True, 0), sizes.get(False, 0)
    if not nt or not nc:
        return OrdinalModel()
    totals = {bool(r["t"]): r["n"] for r in one_label(labels).groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    seen = (feats.mapInPandas(_explode, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
            .where(F.col("a") + F.col("b") >= MIN_ROWS))
    pa, pb = F.col("a") / nt, F.col("b") / nc
    chi = (pa - pb) * (pa - pb) / (F.col("a") + F.col("b")) * (nt + nc)
    top = seen.withColumn("chi", chi).orderBy(F.desc("chi"), "f").limit(max_features)
    chosen = [(r["f"], r["a"], r["b"]) for r in top.collect()]  # at most max_features rows
    names = sorted({"#", *(f for f, _, _ in chosen)})
    number = {f: i for i, f in enumerate(names)}
    # marked: at least 20 times as frequent in toxic rows
    marked = {f for f, a, b in chosen if a / nt >= 20 * (b + 0.5) / nc}

    def pick(batches):
        for pdf in batches:
            counts = [_counts(ws) for ws in pdf["words"]]
            hits = [sum(any(f in marked for f in word_features(w)) for w in ws) for ws in pdf["words"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "grade": [0 if t <= 0 else 1 if h <= 1 else 2 if h <= 3 else 3 for t, h in zip(pdf["toxic"], hits, strict=True)],
                                "at": [[number[f] for f in c if f in number] for c in counts],
                                "n": [[n for f, n in c.items() if f in number] for c in counts]})
    data = feats.mapInPandas(pick, "doc_id long, grade int, at array<int>, n array<int>").orderBy("doc_id").collect()  # the bounded sample
    grades = np.asarray([r["grade"] for r in data])
    # a class of which only a part was sampled keeps its weight
    weight = np.where(grades > 0, totals[True] / nt, totals[False] / nc)
    w, theta = fit_ordinal([np.asarray(r["at"], np.int64) for r in data], [value(r["n"]) for r in data], grades, weight, penalties(names), GRADES)
    return OrdinalModel({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-6}, tuple(float(t) for t in theta))


def score(df: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """``df`` with ``tox_score``, the linear predictor of every text."""
    weights = model.weights

    @F.pandas_udf("double")
    def linear(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple] = {}
        for texts in parts:
            yield one(texts, known)

    def one(texts: pd.Series, known: dict[str, tuple]) -> pd.Series:
        out = np.zeros(len(texts))
        for i, t in enumerate(texts):
            words = set(_WORD.findall((t or "").lower()))
            hit: Counter = Counter()
            for w in words:
                fs = known.get(w)
                if fs is None:
                    if len(known) > WORD_CACHE:
                        known.clear()
                    fs = known[w] = tuple(f for f in word_features(w) if f in weights)
                if fs:
                    hit.update(fs)
            hit["#"] = len(words)
            fs = sorted(hit)
            out[i] = float(np.dot([weights.get(f, 0.0) for f in fs], value([hit[f] for f in fs])))
        return pd.Series(out)
    return df.withColumn("tox_score", linear(F.col(text)))


def grade(df: DataFrame, model: OrdinalModel, reject: float = REJECT) -> DataFrame:
    """``df`` with tox_score -> plus severity, grade, p_toxic, rejected."""
    above = [F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(t) - F.col("tox_score"))) for t in model.thresholds]
    each = [F.lit(1.0) - above[0], *[a - b for a, b in zip(above, above[1:], strict=False)], above[-1]]
    top = F.greatest(*each)
    pick = F.coalesce(*[F.when(p == top, F.lit(i)) for i, p in enumerate(each)])
    return (df.withColumn("severity", sum(above[1:], above[0])).withColumn("grade", pick)
            .withColumn("p_toxic", above[0]).withColumn("rejected", above[0] >= reject))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return grade(score(docs, model), model).select("doc_id", "severity", "grade", "p_toxic", "rejected")
