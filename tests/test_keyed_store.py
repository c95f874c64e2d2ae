"""Stores, write-backs and documents that hold a text once, not once per row that shows it."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from newsbeam import operators as op
from newsbeam import session
from newsbeam.functions.keys import HEADLINE_KEY, digest
from newsbeam.session import run_dir
from newsbeam.sources import buckets, store
from newsbeam.sources.fixtures import headlines_view
from newsbeam.streaming import cycle as streams

from .test_text_by_key import LENGTH, N_DOCS, N_EVENTS, _exchanged, shuffled, tables  # noqa: F401

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
AS_OF = dt.datetime(2024, 1, 2, 12)
SCHEMA = "day date, symbol string, feed string, pos long, headline string, created timestamp, processed boolean, labelled int"


def _records(spark):
    rows = [(D1, "x", "A", 1, "one", AS_OF, False, None), (D1, "x", "B", 2, "one", AS_OF, False, None),
            (D1, None, "A", 3, None, AS_OF, False, None), (D2, "y", "A", 4, "", AS_OF, False, None),
            (D2, "y", "A", 4, "", AS_OF, False, None), (D2, "y", "B", 5, "two", AS_OF, False, None),
            (D2, "y", "B", 6, "two", AS_OF, False, None), (D1, None, "B", 7, None, AS_OF, False, None)]
    return spark.createDataFrame(rows, SCHEMA)


def _keyed(df):
    return df.withColumn(HEADLINE_KEY, digest("headline")).drop("headline")


def _texts(df):
    return df.select(digest("headline").alias(HEADLINE_KEY), "headline").distinct()


def _scorer(spark, **how):
    answers = [(1, "negative"), (2, "positive"), (3, "positive"), (4, "neutral"), (6, "negative")]
    return op.RecordedScorer(spark.createDataFrame(answers, "pos long, answer string"), on="pos", **how)


def _rows(df, cols):
    return sorted(map(str, df.select(*cols).collect()))


def _bytes(path):
    path = path.replace("file:", "")
    return sum(os.path.getsize(os.path.join(d, f)) for at in (path, path + "_headlines") for d, _, fs in os.walk(at) for f in fs)


def _watch(monkeypatch):
    """The folders that queries make under the shared one from now on."""
    from newsbeam.plans import keys
    dirs, real = [], session.run_dir
    spy = lambda s, n: dirs.append(real(s, n)) or dirs[-1]
    monkeypatch.setattr(session, "run_dir", spy)
    monkeypatch.setattr(keys, "run_dir", spy)
    monkeypatch.setattr(streams, "_LANDED", {})
    return dirs


@pytest.mark.parametrize("name", ["apply_labels_all", "apply_labels_first", "day_variant"])
def test_a_text_is_not_shuffled_once_per_event(spark, tables, shuffled, name):  # noqa: F811
    """F5 to F7."""
    assert _exchanged(E.queries()[name](spark, tables)) < 8 * N_DOCS * LENGTH  # once per event: N_EVENTS * LENGTH


def test_a_part_moves_its_first_text_only_to_another_last_one(spark, tables, shuffled):  # noqa: F811
    """F8: before, every part moved the texts of both its ends."""
    h = headlines_view(spark, tables, keyed=True).withColumn("part", F.floor(F.col("doc_id") / 100))
    at = h.groupBy("day", "symbol", "feed", "part").agg(F.min_by(HEADLINE_KEY, "doc_id").alias("a"), F.max_by(HEADLINE_KEY, "doc_id").alias("b"))
    parts, two = at.count(), at.where("a <> b").count()
    assert 0 < two < parts
    assert _exchanged(E.queries()["nest_day"](spark, tables)) < (two + 4 * N_DOCS) * LENGTH


@pytest.mark.parametrize("name", ["write_labels_roundtrip", "write_buckets_roundtrip", "stream_cycle", "stream_cycle_runs",
                                  "apply_labels_all", "apply_labels_first", "day_variant", "merge_day"])
def test_rows_equal_the_sql_and_a_text_is_not_stored_once_per_event(spark, tables, monkeypatch, name):  # noqa: F811
    """F1 to F4: landings and stores hold the texts, and few times (once per event: N_EVENTS * LENGTH, two thirds of it in zstd)."""
    duckdb = pytest.importorskip("duckdb")
    dirs = _watch(monkeypatch)
    con = duckdb.connect()
    for t in ("documents", "events", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    got = E.queries()[name](spark, tables)
    want, columns = con.sql(E.oracle_sql()[name]), got.columns
    at = [want.columns.index(c) for c in columns]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    got, want = sorted((tuple(r) for r in got.collect()), key=key), sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=key)
    if name in ("write_buckets_roundtrip", "merge_day"):  # the SQL takes every null headline of feed B for a new one, the merge does not
        text = columns.index("headline")
        got, want = ([r for r in x if r[text] is not None] for x in (got, want))
    assert got == want
    if name.startswith(("write_", "stream_")):
        assert N_DOCS * LENGTH / 3 < sum(_bytes(d) for d in dirs) < N_EVENTS * LENGTH / 6


def test_nest_day_ends_with_several_headlines(spark, tmp_path):
    """Two documents under one id: the ends of a part are the least and the greatest text at their positions."""
    at = str(tmp_path)
    spark.createDataFrame([(0, "b", "x"), (0, "a", "x"), (1, "c", "x"), (1, "d", "x"), (2, "e", "y")],
                          "doc_id long, text string, source string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, dt.datetime(2024, 1, 1, 0, i)) for i in range(9)], "event_id long, ts timestamp_ntz").write.parquet(f"{at}/events.parquet")
    got = sorted(tuple(r) for r in E.queries()["nest_day"](spark, at).select("symbol", "n_records", "first_headline", "last_headline").collect())
    assert got == [("x", 12, "a", "d"), ("y", 3, "e", "e")]


@pytest.mark.parametrize("mode", ["all", "first_match"])
def test_keyed_rows_are_labelled_as_rows(spark, mode):
    records, cols = _records(spark), ["day", "symbol", "feed", "pos", "processed", "labelled"]
    keyed = _keyed(records)
    got = op.apply_labels(keyed, op.label_keys(keyed, _scorer(spark, hashed=False)), mode)
    assert HEADLINE_KEY in got.columns and "headline" not in got.columns
    assert _rows(got, cols) == _rows(op.apply_labels(records, op.label_keys(records, _scorer(spark)), mode), cols)


@pytest.mark.parametrize("first_write", ["dedupe", "keep_all"])
def test_keyed_store_reads_back_as_the_plain_one(spark, first_write):
    records, plain, keyed = _records(spark), run_dir(spark, "ks-plain"), run_dir(spark, "ks-keyed")
    old, new = (records.where(F.col("feed") == f) for f in "AB")
    new = new.drop("created", "processed", "labelled")
    store.write_day(old, plain)
    store.upsert_days(spark, plain, new, AS_OF, first_write)
    store.write_labels(spark, plain, op.label_keys(store.read_store(spark, plain), _scorer(spark)))
    store.write_day(_keyed(old), keyed)
    for batch in (_keyed(old), _keyed(new), _keyed(new)):  # the last one again: a replay adds no text
        store.add_headlines(spark, keyed, _texts(records), batch)
    store.upsert_days(spark, keyed, _keyed(new), AS_OF, first_write)
    rows = store.read_store(spark, keyed, keyed=True)
    store.write_labels(spark, keyed, op.label_keys(rows, _scorer(spark, hashed=False)), keyed=True)
    assert "headline" not in spark.read.parquet(keyed).columns
    assert store.read_headlines(spark, keyed).count() == 4  # one, two, empty, null
    back = store.with_texts(store.read_store(spark, keyed, keyed=True), spark, keyed)
    assert _rows(back, store.HEADLINE_COLS) == _rows(store.read_store(spark, plain), store.HEADLINE_COLS)


def test_keyed_leaves_read_back_as_the_plain_ones(spark):
    records, plain, keyed = _records(spark), run_dir(spark, "kb-plain"), run_dir(spark, "kb-keyed")
    old, new = (records.where(F.col("feed") == f) for f in "AB")
    buckets.write_buckets(old, plain, 4)
    buckets.upsert_buckets(spark, plain, new, AS_OF, 4)
    buckets.write_labels_buckets(spark, plain, op.label_keys(buckets.read_buckets(spark, plain).drop("bucket"), _scorer(spark)), buckets=4)
    buckets.write_buckets(_keyed(old), keyed, 4)
    buckets.upsert_buckets(spark, keyed, _keyed(new), AS_OF, 4)
    rows = buckets.read_buckets(spark, keyed, keyed=True).drop("bucket")
    store.add_headlines(spark, keyed, _texts(records), rows)
    buckets.write_labels_buckets(spark, keyed, op.label_keys(rows, _scorer(spark)), buckets=4, keyed=True)
    back = store.with_texts(buckets.read_buckets(spark, keyed, keyed=True), spark, keyed)
    assert _rows(back, store.HEADLINE_COLS) == _rows(buckets.read_buckets(spark, plain), store.HEADLINE_COLS)


def test_keyed_documents_of_both_shapes(spark):
    records = _records(spark)
    old, new = records.where("feed = 'A'").drop("labelled"), records.where("feed = 'B'")
    docs = op.variant_documents(_keyed(old)).unionByName(op.variant_documents(_keyed(new)))
    back = op.variant_records(docs, HEADLINE_KEY).join(_texts(records), HEADLINE_KEY, "left")
    assert _rows(back, store.HEADLINE_COLS) == _rows(records, store.HEADLINE_COLS)


def test_keyed_cycle_needs_its_texts(spark):
    """A batch without the texts of its keys would leave a store without headlines."""
    path = run_dir(spark, "kc-store")
    cycle = streams.make_cycle(spark, path, run_dir(spark, "kc-snap"), _scorer(spark))
    batch = _keyed(_records(spark)).withColumn(streams.EVENT_TIME, F.lit(AS_OF).cast("timestamp"))
    with pytest.raises(ValueError, match="texts"):
        cycle(batch, 0)
    assert store.read_store(spark, path, keyed=True).count() == 0


def test_answers_as_many_as_the_rows_are_not_hashed(spark):
    """keyed write-backs and replays sort, so no task has to hold its share of the answers in memory."""
    keyed = _keyed(_records(spark))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = op.apply_labels(keyed, op.label_keys(keyed, _scorer(spark, hashed=False)))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan


def test_replay_without_state_keeps_the_callers_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert streams._replay_session(spark, stateful=False).conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
