"""Character references, bucketed store, batches of bounded cost, documents of two shapes."""

import datetime as dt
import glob
import html
import html.entities
import os
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.functions.references import decode_references
from newsbeam.operators.budget import cut_batches
from newsbeam.session import run_dir
from newsbeam.sources import buckets

from .conftest import SF001

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
AS_OF = dt.datetime(2024, 1, 2, 12)

# one row per class of reference
REFERENCES = ["a&amp;b", "&amp;lt;", "&lt", "&notit;", "&notin;", "&#65;", "&#x41", "&#0;", "&#128;", "&#150", "&#129;", "&#xD800;", "&#1114112;",
              "&#99999999999;", "&#11;", "&#13;", "&#xFDD0;", "&#xFFFE;", "&#x1F600;", "&#;", "&#x;", "& b", "&&amp;", "&NotEqualTilde;",
              "&nosuch;", "&ampx;", "&copycat", "no reference", "", None, "&frac12;&frac12", "&#00000000065;", "x&", "&;", "&ngE;", "&thetasym;"]


def test_references_as_the_standard_library(spark):
    rng = random.Random(2)
    names = sorted(html.entities.html5)
    mixed = ["".join(rng.choice(["&" + rng.choice(names), "x ", f"&#{rng.randint(1, 70000)};", f"&#x{rng.randint(1, 0x10ffff):x}"])
                     for _ in range(8)) for _ in range(150)]
    texts = REFERENCES + mixed + ["&" + n for n in names]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", decode_references("t").alias("d"))
    got = {r.i: r.d for r in df.collect()}
    for i, t in enumerate(texts):
        assert got[i] == (None if t is None else html.unescape(t)), t


def test_native_titles_and_zip_agree_with_the_general_path(spark):
    pages = [(i, "https://h.org/", f"<h1>{t}</h1><li>{t}</li>") for i, t in enumerate(REFERENCES) if t and "<" not in t]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    native = {r.page_id: r.t for r in df.select("page_id", F.element_at(op.element_texts("html", "h1"), 1).alias("t")).collect()}
    general = {r.page_id: r.text for r in op.extract_css(df, {"h": "h1"}).collect()}
    assert native == general
    zipped = {r.page_id: r.headline for r in op.extract_items(df, op.element_texts("html", "li"), op.attr_values("html", "href"), feed="A").collect()}
    assert zipped == general


# --------------------------------------------------------------------------- leaves

REC = "day date, symbol string, feed string, pos long, headline string, created timestamp, processed boolean, labelled int"


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/day=*/bucket=*/*.parquet")}


def rows(n, feed="A", day=D1, first=0):
    return [(day, "BTC", feed, first + i, f"headline {i}", AS_OF, False, None) for i in range(n)]


def test_untouched_leaves_keep_their_files(spark):
    path = run_dir(spark, "t-leaves")
    buckets.write_buckets(spark.createDataFrame(rows(60) + rows(60, day=D2, first=100), REC), path, 8)
    before = files_of(path)
    assert len({os.path.dirname(f) for f in before}) == 16
    # repeats only: nothing is written
    buckets.upsert_buckets(spark, path, spark.createDataFrame(rows(60, "B", first=500), REC).drop("created", "processed", "labelled"), AS_OF, 8)
    assert files_of(path) == before
    # one new headline: one leaf is written
    new = spark.createDataFrame([(D1, "BTC", "B", 900, "something new"), (D1, "BTC", "B", 901, "headline 3")],
                                "day date, symbol string, feed string, pos long, headline string")
    buckets.upsert_buckets(spark, path, new, AS_OF, 8)
    after = files_of(path)
    leaf = {os.path.dirname(f) for f in set(after) - set(before)}
    assert len(leaf) == 1
    assert {f: t for f, t in before.items() if os.path.dirname(f) not in leaf} == {f: t for f, t in after.items() if os.path.dirname(f) not in leaf}
    assert buckets.read_buckets(spark, path).count() == 121


def test_relabelled_leaves_only(spark):
    path = run_dir(spark, "t-leaves")
    buckets.write_buckets(spark.createDataFrame(rows(40) + [(D1, None, None, 77, None, AS_OF, False, None)], REC), path, 8)
    stored = buckets.read_buckets(spark, path).drop("bucket")
    labels = spark.createDataFrame(stored.withColumn("label", F.lit(1)).collect(), stored.withColumn("label", F.lit(1)).schema)
    buckets.write_labels_buckets(spark, path, labels, buckets=8)
    before = files_of(path)
    buckets.write_labels_buckets(spark, path, labels, buckets=8)  # the same labels again
    assert files_of(path) == before
    buckets.write_labels_buckets(spark, path, labels.withColumn("label", F.when(F.col("pos") == 5, -1).otherwise(1)), buckets=8)
    after = files_of(path)
    assert len({os.path.dirname(f) for f in set(after) - set(before)}) == 1
    got = {r.pos: (r.processed, r.labelled) for r in buckets.read_buckets(spark, path).collect()}
    assert got == {p: (True, -1 if p == 5 else 1) for p in [*range(40), 77]}


# --------------------------------------------------------------------------- batches of bounded cost


def test_cut_batches():
    rng = np.random.default_rng(4)
    for _ in range(50):
        lengths = np.sort(rng.integers(0, 60, rng.integers(1, 80)))
        cut = cut_batches(lengths, 100)
        assert [x for lo, hi in cut for x in range(lo, hi)] == list(range(len(lengths)))
        for k, (lo, hi) in enumerate(cut):
            assert hi - lo == 1 or (hi - lo) * lengths[hi - 1] <= 100
            if k:  # the batch before could not take this one's first row
                assert (lo + 1 - cut[k - 1][0]) * max(lengths[lo], 1) > 100


def test_every_batch_is_within_the_budget(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    seen = spark.sparkContext.accumulator(0)

    def model(max_length=None):
        def generate(prompts: pd.Series) -> pd.Series:
            seen.add(len(prompts))
            return prompts + "neutral"
        return generate
    scorer = op.BudgetedScorer(model, budget=4000, partitions=3)
    batches = scorer.batches(docs, "text").cache()
    assert batches.count() == docs.count() == seen.value
    costs = op.batch_costs(batches).collect()
    assert all(r.cost <= 4000 or r.n_rows == 1 for r in costs) and any(r.n_rows > 1 for r in costs)
    got = {r.doc_id: r.answer for r in scorer.score(docs, "text").collect()}
    assert set(got.values()) == {"neutral"} and len(got) == docs.count()


def test_null_texts_and_many_equal_lengths(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else "same") for i in range(200)], "id int, headline string")
    out = op.BudgetedScorer(op.lexicon_model(), budget=300, partitions=4).score(df)
    got = {r.id: r.answer for r in out.collect()}
    assert got == {i: None if i % 10 == 0 else "neutral" for i in range(200)}


# --------------------------------------------------------------------------- documents of two shapes


def test_both_shapes_in_one_column(spark):
    old = spark.createDataFrame([(D1, "BTC", "A", 1, "x", AS_OF, False), (D1, "BTC", "A", 0, None, AS_OF, None)],
                                "day date, symbol string, feed string, pos long, headline string, created timestamp, processed boolean")
    new = spark.createDataFrame([(D1, "BTC", "B", 5, 'quote " and \\', AS_OF, True, -1), (D1, None, "B", 105, "y", AS_OF, True, None)], REC)
    docs = op.variant_documents(old).unionByName(op.variant_documents(new))
    assert docs.schema["document"].dataType.simpleString() == "variant" and docs.count() == 3
    got = sorted((r.pos, r.symbol, r.headline, r.created, r.processed, r.labelled) for r in op.variant_records(docs).collect())
    assert got == [(0, "BTC", None, AS_OF, None, None), (1, "BTC", "x", AS_OF, False, None),
                   (5, "BTC", 'quote " and \\', AS_OF, True, -1), (105, None, "y", AS_OF, True, None)]
    shapes = {r.fields: r.records for r in op.variant_shapes(docs).collect()}
    assert shapes == {"created,headline,pos,processed": 2, "created,headline,labelled,pos,processed": 2}
