"""Queries that move a headline once per text, not once per event that shows it: rows and bytes moved."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from newsbeam import operators as op
from newsbeam.session import arrow_batches
from newsbeam.sources.fixtures import headlines_view, with_headlines

N_DOCS, N_EVENTS, LENGTH = 12, 720, 20_000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Long documents that many events show; one null text, one equal text under two ids."""
    at = str(tmp_path_factory.mktemp("tables"))
    rnd = random.Random(5)
    text = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=LENGTH)) for _ in range(N_DOCS)]
    text[3], text[4] = None, text[5]
    spark.createDataFrame([(i, t, "en", f"src{i % 3}", LENGTH) for i, t in enumerate(text)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    start = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i, start + dt.timedelta(minutes=13 * i)) for i in range(N_EVENTS)], "event_id long, ts timestamp_ntz") \
        .write.parquet(f"{at}/events.parquet")
    spark.createDataFrame([(i, i % 2, i % 3) for i in range(0, N_DOCS, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def _exchanged(df) -> int:
    """Bytes that the exchanges of the executed plan of ``df`` took in."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ShuffleExchangeExec":
            total += node.metrics().get("dataSize").get().value()
        if not name.endswith("QueryStageExec") and name != "AdaptiveSparkPlanExec":
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["raw_answers", "parse_answer", "unnest_day", "day_documents", "day_document_scalars"])
def test_a_text_is_not_moved_once_per_event(spark, tables, shuffled, name):
    moved = _exchanged(E.queries()[name](spark, tables))
    assert moved < 4 * N_DOCS * LENGTH  # once per event: N_EVENTS * LENGTH


@pytest.mark.parametrize("name", ["nest_day", "nest_day_records"])
def test_a_text_goes_to_a_part_once(spark, tables, shuffled, name):
    h = headlines_view(spark, tables, keyed=True).withColumn("part", F.floor(F.col("doc_id") / 100))
    n = h.select("day", "symbol", "feed", "part", "headline_key").distinct().count()
    assert n < N_EVENTS / 2
    assert _exchanged(E.queries()[name](spark, tables)) < (n + 4 * N_DOCS) * LENGTH


@pytest.mark.parametrize("name", ["stream_drop_late", "stream_dedupe", "stream_dedupe_store", "stream_dedupe_state"])
def test_landed_files_hold_no_text_per_event(spark, tables, monkeypatch, name):
    from newsbeam.streaming import cycle
    landed = []
    land = cycle.land_by_day
    monkeypatch.setattr(cycle, "_LANDED", {})
    monkeypatch.setattr(cycle, "land_by_day", lambda s, df, path, *a: landed.append(land(s, df, path, *a)) or landed[-1])
    E.queries()[name](spark, tables).collect()
    rows = spark.read.parquet(landed[0])
    assert rows.count() == N_EVENTS
    assert "headline" not in rows.columns and rows.select("headline_key").distinct().count() == N_DOCS - 1


@pytest.mark.parametrize("name", ["raw_answers", "parse_answer", "unnest_day", "nest_day_records", "day_documents",
                                  "day_document_scalars", "stream_dedupe", "stream_drop_late"])
def test_rows_equal_the_sql(spark, tables, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "events", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    got = E.queries()[name](spark, tables)
    want = con.sql(E.oracle_sql()[name])
    at = [want.columns.index(c) for c in got.columns]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=key)


def test_keyed_view_is_the_view_when_ids_repeat(spark, tmp_path):
    """Two documents under one id, two events under one id: the same rows, as often."""
    at = str(tmp_path)
    spark.createDataFrame([(0, " a ", "x"), (0, "b", "x"), (1, "a", "y"), (2, None, "y"), (3, "", None)],
                          "doc_id long, text string, source string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i % 15, dt.datetime(2024, 1, 1, 0, i)) for i in range(40)], "event_id long, ts timestamp_ntz").write.parquet(f"{at}/events.parquet")
    plain = headlines_view(spark, at, ages=True)
    back = with_headlines(headlines_view(spark, at, ages=True, keyed=True), spark, at).select(*plain.columns)
    assert back.count() == plain.count()
    assert back.exceptAll(plain).count() == plain.exceptAll(back).count() == 0
    nested = op.nest_day(plain.select("day", "symbol", "feed", F.col("doc_id").alias("pos"), "headline"), 100)
    old = nested.select(F.col("day").cast("string").alias("day"), "symbol", "feed", "part", F.element_at("records", 1)["headline"].alias("first_headline"),
                        F.element_at("records", -1)["headline"].alias("last_headline"))
    new = E.queries()["nest_day"](spark, at).drop("n_records")
    assert new.exceptAll(old).count() == old.exceptAll(new).count() == 0


def test_a_model_gets_prompts_in_bounded_batches(spark, tmp_path):
    """however many prompts a task has, Python holds at most a batch of them."""
    sizes = str(tmp_path / "sizes")

    def factory(max_length=None):
        def generate(prompts):
            with open(sizes, "a") as f:  # tests run in local mode
                f.write(f"{len(prompts)} {prompts.str.len().sum()}\n")
            return prompts + "neutral"
        return generate

    h = spark.range(0, 3000, 1, 1).select(F.concat(F.repeat(F.lit("x"), 40_000), F.col("id").cast("string")).alias("headline")) \
        .unionByName(spark.range(0, 4000, 1, 1).select(F.col("id").cast("string").alias("headline")))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    try:
        op.fill_memo(h.coalesce(1), str(tmp_path / "memo"), factory, "first")
        with arrow_batches(spark, 5, "1m"):
            assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "5"
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    asked = [tuple(map(int, line.split())) for line in open(sizes)]
    assert sum(n for n, _ in asked) == 7000
    assert max(n for n, _ in asked) <= 1024 and max(c for _, c in asked) < 6 << 20
    assert op.read_memo(spark, str(tmp_path / "memo")).where("answer = 'neutral'").count() == 7000
