"""Literal-row cases of the recurring job that once lost or multiplied rows."""

import datetime as dt

from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.sources import store

DAY = dt.date(2024, 8, 5)


def test_two_landings_of_a_page_do_not_mix(spark):
    html = "<nav><ul><li><a>{}</a></li></ul></nav><div class='ad'>{}</div>"
    pages = spark.createDataFrame([(1, "http://x.com/a", html.format("one", "5 minutes ago")), (1, "http://x.com/a", html.format("two", "9 minutes ago"))],
                                  "page_id long, url string, html string")
    out = op.extract_headlines(pages, "nav li a", "div.ad", feed="A")
    assert sorted((r.headline, r.date_text) for r in out.collect()) == [("one", "5 minutes ago"), ("two", "9 minutes ago")]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_null_keys_are_known_after_the_first_merge(spark):
    rows = spark.createDataFrame([(DAY, None, "h")], "day date, symbol string, headline string")
    assert op.novel(rows, rows).count() == 0


def test_label_write_back_keeps_the_row_count(spark):
    rec = "day date, symbol string, feed string, pos long, headline string, created timestamp, processed boolean, labelled int"
    at = dt.datetime(2024, 8, 5, 12)
    rows = spark.createDataFrame([(DAY, "BTC", "A", 0, "h", at, False, None)] * 2, rec)
    out = op.apply_labels(rows, rows.withColumn("label", F.lit(1)))
    assert [(r.processed, r.labelled) for r in out.collect()] == [(True, 1)] * 2


def test_scored_symbols_outside_the_universe_stay(spark):
    lab = spark.createDataFrame([(DAY, "ETH", 1)], "day date, symbol string, label int")
    uni = spark.createDataFrame([(DAY, "BTC")], "day date, symbol string")
    assert {(r.symbol, r.score) for r in op.net_score(lab, uni).collect()} == {("ETH", 1), ("BTC", 0)}


def test_snapshots_of_two_days_with_one_run_time_both_stay(spark, tmp_path):
    at, path = dt.datetime(2024, 8, 6, 1), str(tmp_path / "snap")
    assert store.read_snapshots(spark, path).count() == 0
    for d in (DAY, dt.date(2024, 8, 6)):
        store.append_snapshot(spark.createDataFrame([(d, 1, "BTC", 2)], "day date, rank int, symbol string, score long"), path, at)
    assert store.read_snapshots(spark, path).select("day").distinct().count() == 2


def test_merged_map_holds_every_headline_and_the_empty_lists(spark):
    cols = "day date, symbol string, headline string, pos long"
    stored = spark.createDataFrame([(DAY, "BTC", "a", 0), (DAY, "BTC", "a", 1)], cols)
    batch = spark.createDataFrame([(DAY, "BTC", "a", 0), (DAY, "BTC", "b", 1), (DAY, "BTC", "b", 2), (DAY, None, "c", 3)], cols)
    uni = spark.createDataFrame([(DAY, "BTC"), (DAY, "ETH")], "day date, symbol string")
    got = sorted((str(r.symbol), str(r.headline), str(r.origin)) for r in op.merge_symbol_rows(stored, batch, uni).collect())
    assert got == [("BTC", "a", "stored"), ("BTC", "a", "stored"), ("BTC", "b", "added"), ("ETH", "None", "None"),
                   ("None", "c", "added")]


def test_extraction_does_not_depend_on_the_selector_shape(spark):
    html = "<body><!-- <p class='t'>no</p> --><p class='t'>a &rsquo; &mdash; &#8217; &eacute;</p></body>"
    pages = spark.createDataFrame([(1, "http://x.com/a", html)], "page_id long, url string, html string")
    for css in ("p.t", "body p.t"):
        assert [r.headline for r in op.extract_headlines(pages, css, "div.d").collect()] == ["a ’ — ’ é"]


def test_length_limit_reaches_the_model(spark):
    def factory(max_length):
        return lambda prompts: prompts + f"limit {max_length}"
    df = spark.createDataFrame([("x", 1), (None, 2)], "headline string, k int")
    got = {r.k: r.answer for r in op.score_headlines(df, op.PandasScorer(factory, max_length=77)).collect()}
    assert got == {1: "limit 77", 2: None}
