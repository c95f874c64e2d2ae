"""Incremental mechanisms: digests as keys, score deltas, answer memo, stateful de-duplication with late rows."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsbeam import jobs
from newsbeam import operators as op
from newsbeam.functions.keys import digest
from newsbeam.operators.deltas import latest_labels
from newsbeam.session import ROCKSDB_STATE, run_dir
from newsbeam.streaming import cycle as streams
from newsbeam.streaming.seen import dedupe_with_state, split_writer

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
ITEM = "day date, symbol string, headline string, pos long"


def explain(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


# --------------------------------------------------------------------------- digests


def test_digest_tells_values_apart(spark):
    pairs = [("a", "bc"), ("ab", "c"), ("", None), (None, ""), (None, None), ("", ""), ("-", "-"), ("1:a", "b"), ("é", "e"), ("null", None)]
    df = spark.createDataFrame(pairs, "a string, b string").select(digest("a", "b").alias("d"), F.length(digest("a", "b")).alias("n"))
    rows = df.collect()
    assert len({bytes(r.d) for r in rows}) == len(pairs) and {r.n for r in rows} == {32}


def test_novel_firsts_shuffles_the_text_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.createDataFrame([(D1, "BTC", "x", 2), (D1, "BTC", "x", 1), (D1, None, "n", 3), (D1, "BTC", "old", 4)], ITEM)
        stored = spark.createDataFrame([(D1, "BTC", "old", 9), (D1, "BTC", "old", 10), (D1, None, "y", 11)], ITEM)
        out = op.novel_firsts(batch, stored)
        assert explain(out).count("Exchange hashpartitioning") == 2  # batch rows and stored digests
        assert sorted((r.symbol or "", r.headline, r.pos) for r in out.collect()) == [("", "n", 3), ("BTC", "x", 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --------------------------------------------------------------------------- null symbols


def test_null_symbol_is_one_symbol(spark):
    lab = spark.createDataFrame([(D1, None, 1), (D1, "BTC", -1), (D1, "", 1), (D1, None, 1)], "day date, symbol string, label int")
    universe = spark.createDataFrame([(D1, None, 3), (D1, "BTC", 1), (D1, "ETH", 2)], "day date, symbol string, ord int")
    got = {(r.symbol, r.ord): r.score for r in op.net_score(lab, universe).collect()}
    assert got == {(None, 3): 2, ("BTC", 1): -1, ("ETH", 2): 0, ("", None): 1}
    assert op.rank_scores(op.net_score(lab, universe)).count() == 4


def test_maps_and_rows_agree_on_null_symbols(spark):
    stored = spark.createDataFrame([(D1, None, "x", 1), (D1, "", "y", 2)], ITEM)
    batch = spark.createDataFrame([(D1, None, "x", 3), (D1, None, "z", 4), (D1, "", "y", 5)], ITEM)
    maps = {r.symbol: (r.n_stored, r.n_added, r.n_total) for r in op.merge_symbol_maps(stored, batch).collect()}
    assert maps == {None: (1, 1, 2), "": (1, 0, 1)}
    rows = op.merge_symbol_rows(stored, batch, batch.select("day", "symbol"))
    counts = {r.symbol: r["count"] for r in rows.groupBy("symbol").count().collect()}
    assert counts == {s: n[2] for s, n in maps.items()}


def test_null_symbol_survives_nonempty(spark):
    items = spark.createDataFrame([(None,), ("BTC",), (None,)], "symbol string")
    universe = spark.createDataFrame([(None,), ("BTC",), ("ETH",), ("",)], "symbol string")
    assert {r.symbol for r in op.nonempty_symbols(items, universe).collect()} == {None, "BTC"}


def test_write_back_with_null_keys(spark):
    rec = "day date, symbol string, feed string, pos long, headline string, created timestamp, processed boolean, labelled int"
    t = dt.datetime(2024, 1, 1, 5)
    rows = [(D1, None, "A", 1, "x", t, False, None), (D1, None, "A", 2, "x", t, False, None), (D1, "BTC", None, 3, None, t, False, None)]
    records = spark.createDataFrame(rows, rec)
    labels = records.withColumn("label", F.when(F.col("pos") == 1, 1).otherwise(-1))
    got = {r.pos: (r.processed, r.labelled) for r in op.apply_labels(records, labels).collect()}
    assert got == {1: (True, 1), 2: (True, -1), 3: (True, -1)}
    first = {r.pos: (r.processed, r.labelled) for r in op.apply_labels(records, labels, "first_match").collect()}
    assert first == {1: (True, -1), 2: (False, None), 3: (True, -1)}


# --------------------------------------------------------------------------- score deltas

LAB = "day date, symbol string, headline string, label int"


def scores(spark, path, up_to=None):
    return {(r.day, r.symbol): (r.score, r.headlines) for r in op.net_from_deltas(op.read_deltas(spark, path), up_to).collect()}


def test_deltas_follow_changed_labels(spark):
    log, deltas = run_dir(spark, "t-log"), run_dir(spark, "t-deltas")
    one = spark.createDataFrame([(D1, "BTC", "a", 1), (D1, "BTC", "a", 1), (D1, None, "b", -1), (D2, "BTC", "a", 1)], LAB)
    two = spark.createDataFrame([(D1, "BTC", "a", -1), (D1, "BTC", "c", 1), (D1, None, "b", -1)], LAB)
    three = spark.createDataFrame([(D1, None, "b", None), (D2, "BTC", "a", 0)], LAB)
    for n, batch in enumerate((one, two, three)):
        op.apply_batch(spark, batch, log, deltas, n)
    assert scores(spark, deltas, 0) == {(D1, "BTC"): (1, 1), (D1, None): (-1, 1), (D2, "BTC"): (1, 1)}
    assert scores(spark, deltas, 1) == {(D1, "BTC"): (0, 2), (D1, None): (-1, 1), (D2, "BTC"): (1, 1)}
    assert scores(spark, deltas) == {(D1, "BTC"): (0, 2), (D1, None): (0, 0), (D2, "BTC"): (0, 1)}
    # a headline whose label did not change left nothing in the second batch
    assert op.read_label_log(spark, log).where("batch_id = 1").count() == 2
    # the full recount of the last labels is the sum of the deltas
    full = latest_labels(op.read_label_log(spark, log)).groupBy("day", "symbol").agg(F.coalesce(F.sum("label"), F.lit(0)).alias("s"))
    assert {(r.day, r.symbol): r.s for r in full.collect()} == {k: v[0] for k, v in scores(spark, deltas).items()}


def test_a_replayed_batch_changes_nothing(spark):
    log, deltas = run_dir(spark, "t-log"), run_dir(spark, "t-deltas")
    one = spark.createDataFrame([(D1, "BTC", "a", 1), (D1, "ETH", "b", -1)], LAB)
    two = spark.createDataFrame([(D1, "BTC", "a", -1)], LAB)
    for n, batch in ((0, one), (1, two), (1, two)):
        op.apply_batch(spark, batch, log, deltas, n)
    assert scores(spark, deltas) == {(D1, "BTC"): (-1, 1), (D1, "ETH"): (-1, 1)}


class CountingScorer:
    """Answers ``positive``; remembers the headlines it was given."""

    def __init__(self):
        self.given = []

    def score(self, df, text_col="headline"):
        self.given.append(sorted(r[0] for r in df.select(text_col).collect()))
        return df.withColumn("answer", F.lit("positive"))


def test_delta_cycle_scores_only_new_headlines(spark):
    log, deltas = run_dir(spark, "t-log"), run_dir(spark, "t-deltas")
    scorer = CountingScorer()
    cycle = op.delta_cycle(spark, log, deltas, scorer)
    cycle(spark.createDataFrame([(D1, "BTC", "a", 1), (D1, "BTC", "b", 2)], ITEM), 0)
    cycle(spark.createDataFrame([(D1, "BTC", "b", 3), (D1, "BTC", "c", 4), (D2, "BTC", "b", 5)], ITEM), 1)
    assert scorer.given == [["a", "b"], ["b", "c"]]
    assert scores(spark, deltas) == {(D1, "BTC"): (3, 3), (D2, "BTC"): (1, 1)}


# --------------------------------------------------------------------------- answer memo


def counting_model(calls):
    def build(max_length=None):
        def generate(prompts: pd.Series) -> pd.Series:
            calls.add(len(prompts))
            return prompts + "positive"
        return generate
    return build


def test_model_sees_each_prompt_once(spark):
    calls = spark.sparkContext.accumulator(0)
    path = run_dir(spark, "t-memo")
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(["a", "b", "a", None, "a", ""])], "id long, headline string")
    got = {r.id: r.answer for r in op.MemoScorer(counting_model(calls), path, "one").score(rows).collect()}
    assert got == {0: "positive", 1: "positive", 2: "positive", 3: None, 4: "positive", 5: "positive"}
    assert calls.value == 3
    op.MemoScorer(counting_model(calls), path, "two").score(rows).collect()
    assert calls.value == 3  # nothing on the second run
    more = rows.unionByName(spark.createDataFrame([(9, "c")], "id long, headline string"))
    assert op.MemoScorer(counting_model(calls), path, "three").score(more).where("id = 9").first().answer == "positive"
    assert calls.value == 4 and op.read_memo(spark, path).count() == 4


def test_a_repeated_run_replaces_its_own_answers(spark):
    calls = spark.sparkContext.accumulator(0)
    path = run_dir(spark, "t-memo")
    rows = spark.createDataFrame([("a",), ("b",)], "headline string")
    for _ in range(2):
        op.fill_memo(rows, path, counting_model(calls), "one")
    assert op.read_memo(spark, path).count() == 2


def test_chat_answers_are_stripped(spark):
    def build(max_length=None):
        return lambda prompts: prompts.map(lambda p: " negative\n")
    rows = spark.createDataFrame([("a",)], "headline string")
    assert op.label_headlines(rows, op.PandasScorer(build, chat=True)).first().label == -1


# --------------------------------------------------------------------------- stateful de-duplication

SEEN = "day date, symbol string, headline string, event_time timestamp"


@pytest.fixture()
def rocks(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    for k, v in ROCKSDB_STATE.items():
        session.conf.set(k, v)
    return session


def test_late_rows_are_kept(spark, rocks):
    def row(day, headline, hour, symbol="BTC"):
        d = dt.date(2024, 1, day)
        return d, symbol, headline, dt.datetime(2024, 1, day, hour)
    landings = [[row(1, "a", 1), row(1, "a", 2), row(1, "b", 3), row(1, None, 3, None)],
                [row(1, "a", 9), row(2, "a", 1), row(1, None, 4, None)],  # a repeat of the day, a new day, a repeat of null
                [row(9, "z", 1)],  # closes both days
                [row(10, "z", 1)],
                [row(1, "c", 5), row(1, "c", 6), row(9, "z", 2), row(1, "d", 7)]]  # too late, twice; a repeat; too late
    src, first, late, ck = (run_dir(spark, f"t-{x}") for x in ("src", "first", "late", "ck"))
    schema = spark.createDataFrame([], SEEN).schema
    for rows in landings:
        spark.createDataFrame(rows, SEEN).coalesce(1).write.mode("append").parquet(src)
        out = dedupe_with_state(rocks.readStream.schema(schema).parquet(src), buckets=2)
        q = (out.writeStream.foreachBatch(split_writer(first, late)).option("checkpointLocation", ck).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    key = lambda r: (r.day.day, r.symbol, r.headline)
    got_first = sorted(map(key, spark.read.parquet(first).collect()), key=str)
    got_late = sorted(map(key, spark.read.parquet(late).collect()))
    assert got_first == sorted([(1, "BTC", "a"), (1, "BTC", "b"), (1, None, None), (2, "BTC", "a"), (9, "BTC", "z"), (10, "BTC", "z")], key=str)
    assert got_late == [(1, "BTC", "c"), (1, "BTC", "d")]
    times = {key(r): r.event_time.hour for r in spark.read.parquet(first).collect()}
    assert times[(1, "BTC", "a")] == 1  # the first copy by event time


def test_days_land_in_the_given_order(spark):
    h = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in range(1, 7) for _ in range(3)], "day date, n int")
    path = streams.land_by_day(spark, h, run_dir(spark, "t-land"), streams._out_of_order)
    stream = spark.readStream.schema(h.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(path)
    seen = []
    q = (stream.writeStream.foreachBatch(lambda b, i: seen.extend(r.n for r in b.select("n").distinct().collect()))
         .option("checkpointLocation", run_dir(spark, "t-ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert list(dict.fromkeys(seen)) == [5, 6, 3, 4, 1, 2]
    assert spark.read.schema(h.schema).option("recursiveFileLookup", "true").parquet(path).count() == 18


# --------------------------------------------------------------------------- job options


def test_feeds_by_name():
    assert jobs.feeds_of("a,b") == (jobs.FEED_A, jobs.FEED_B)
    assert jobs.feeds_of("a_old") == (jobs.FEED_A_OLD,)
    within = jobs.feeds_of("a,b", "within", 60)
    assert (within[0].rule, within[0].minutes, within[1].rule) == ("within", 60, "same_day")


def test_run_takes_the_options_of_both(spark):
    html = '<h5 class="t">x</h5><span class="age">an hour ago</span><h5 class="t">y</h5><span class="age">45 minutes ago</span>'
    page = [("BTC", "A", "u1", html, dt.datetime(2024, 1, 2, 10))]
    base = run_dir(spark, "t-run")
    spark.createDataFrame(page, "symbol string, feed string, url string, html string, landed_at timestamp").write.parquet(f"{base}/landing")
    feed = jobs.Feed("A", "h5.t", "span.age", "within", 50)
    jobs.run(spark, f"{base}/landing", f"{base}/store", f"{base}/snap", f"{base}/ck", available_now=True, feeds=(feed,),
             quarantine_path=f"{base}/quarantine", only_unprocessed=True, label_mode="contains", write_back="first_match").awaitTermination()
    stored = spark.read.parquet(f"{base}/store").collect()
    assert [(r.headline, r.processed) for r in stored] == [("y", True)]
    assert spark.read.parquet(f"{base}/snap").count() == 1
