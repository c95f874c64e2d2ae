"""The ingest and score jobs on literal pages carrying the feeds' markup."""

import datetime as dt

from pyspark.sql import functions as F

from newsbeam import jobs
from newsbeam.session import run_dir
from newsbeam.sources import store

AS_OF = dt.datetime(2023, 8, 5, 10, 0, 0)


def _a_item(headline, age):
    return (f'<div class="sc-aef7b723-0 dDQUel news_title"><h5 class="sc-16891c57-0 fmcNVa base-text">'
            f'{headline}</h5></div><p><span class="sc-16891c57-0 dZnbgJ base-text"> {age} </span></p>')


def _b_item(headline, date):
    return (f'<a class="Box-sc-1hpkeeg-0 hBnhmi" href="/x"><h6 class="typography__StyledTypography-sc-owin6q-0 fkaXgH">'
            f'{headline}</h6></a><div class="searchstyles__DateWrapper-sc-ci5zlg-24 iQeyNE">'
            f'<h6 class="typography__StyledTypography-sc-owin6q-0 fQGhGk">{date}</h6></div>')


def _pages(spark):
    rows = [
        ("BTC", "A", "https://a/btc", "<html><body>" + _a_item("BTC is trash", "5 minutes ago")
         + _a_item("BTC old", "45 minutes ago") + _a_item("BTC odd", "few minutes ago")
         + _a_item("BTC &amp; ETH", "an hour ago") + "</body></html>"),
        ("DOGE", "A", "https://a/doge", "<html>" + _a_item("DOGE late", "2 hours ago") + "</html>"),
        ("ETH", "B", "https://b/eth", "<html>" + _b_item("ETH up", "Aug 05, 2023")
         + _b_item("ETH older", "Aug 04, 2023") + _b_item("ETH up", "Aug 05, 2023") + "</html>"),
        ("BTC", "B", "https://b/btc", "<html>" + _b_item("BTC is trash", "Aug 05, 2023") + "</html>"),
    ]
    return spark.createDataFrame(rows, "symbol string, feed string, url string, html string")


def test_ingest_then_score(spark):
    path, snaps, quar = run_dir(spark, "j-store"), run_dir(spark, "j-snap"), run_dir(spark, "j-quar")
    pages = _pages(spark)
    jobs.ingest(spark, pages, path, AS_OF, quarantine_path=quar)
    rows = sorted((r.symbol, r.feed, r.headline) for r in store.read_store(spark, path).collect())
    assert rows == [("BTC", "A", "BTC & ETH"), ("BTC", "A", "BTC is trash"), ("ETH", "B", "ETH up")]
    q = spark.read.parquet(quar).collect()
    assert [(r.symbol, r.date_text, r.reason) for r in q] == [("BTC", "few minutes ago", "unreadable_age")]
    syms = {r.symbol: r.ord for r in store.read_day_symbols(spark, jobs.symbols_path(path)).collect()}
    assert syms == {"BTC": 0, "DOGE": 4, "ETH": 2}

    jobs.ingest(spark, pages, path, AS_OF)  # a replayed run adds nothing
    assert store.read_store(spark, path).count() == 3

    ranked = jobs.score(spark, path, snaps, AS_OF).orderBy("rank").collect()
    assert [(r.symbol, r.score) for r in ranked] == [("ETH", 0), ("DOGE", 0), ("BTC", -1)]
    assert store.read_store(spark, path).where(~F.col("processed")).count() == 0
    snap = store.read_snapshots(spark, snaps).collect()
    assert len(snap) == 3 and {r.created for r in snap} == {AS_OF}


def test_run_cycle_over_landed_pages(spark):
    """The endless cycle, one available-now trigger over a landing folder."""
    landing = run_dir(spark, "j-landing")
    pages = _pages(spark).withColumn("landed_at", F.lit(AS_OF).cast("timestamp"))
    pages.write.parquet(landing)
    path, snaps = run_dir(spark, "j-run-store"), run_dir(spark, "j-run-snap")
    q = jobs.run(spark, landing, path, snaps, run_dir(spark, "j-run-ck"), available_now=True)
    q.awaitTermination()
    assert store.read_store(spark, path).count() == 3
    assert store.read_store(spark, path).where(~F.col("processed")).count() == 0
    assert sorted((r.symbol, r.score) for r in store.read_snapshots(spark, snaps).collect()) == [
        ("BTC", -1), ("DOGE", 0), ("ETH", 0)]


def test_run_keeps_pages_without_landing_time_in_quarantine(spark):
    landing = run_dir(spark, "j-null-landing")
    at = F.when(F.col("symbol") != "ETH", F.lit(AS_OF)).cast("timestamp")
    pages = _pages(spark).withColumn("landed_at", at)
    pages.write.parquet(landing)
    path, snaps = run_dir(spark, "j-null-store"), run_dir(spark, "j-null-snap")
    jobs.run(spark, landing, path, snaps, run_dir(spark, "j-null-ck"), available_now=True).awaitTermination()
    lost = spark.read.parquet(path + "_quarantine").where("reason = 'no landing time'")
    assert lost.count() == pages.where("landed_at IS NULL").count() > 0
    assert {(r.symbol, r.day, r.run) for r in lost.collect()} == {("ETH", None, "batch-0")}
    assert store.read_store(spark, path).where("symbol = 'ETH'").count() == 0


def test_seeds_cli_stores_unknown_tickers(spark, monkeypatch):
    out = run_dir(spark, "j-seeds")
    monkeypatch.delitem(jobs.SLUGS, "BTC")
    jobs.main(["seeds", "--out", out, "--base-a", "https://a/c/", "--base-b", "https://b/s"])
    assert spark.read.parquet(out).count() == 2 * len(jobs.SYMBOLS) - 1
    assert [r.symbol for r in spark.read.parquet(out + "_unknown_symbols").collect()] == ["BTC"]


def test_seeds(spark):
    urls, unknown = jobs.seeds(spark, symbols=["BTC", "ETH", "NEW"], base_a="https://a/c/", base_b="https://b/s")
    got = sorted((r.symbol, r.feed, r.url) for r in urls.collect())
    assert got == [("BTC", "A", "https://a/c/bitcoin"), ("BTC", "B", "https://b/s?s=BTC&sort=1"),
                   ("ETH", "A", "https://a/c/ethereum"), ("ETH", "B", "https://b/s?s=ETH&sort=1"),
                   ("NEW", "B", "https://b/s?s=NEW&sort=1")]
    assert [(r.symbol, r.reason) for r in unknown.collect()] == [("NEW", "unknown_symbol")]
    assert urls.where("feed = 'A'").count() == 2 and len(jobs.SYMBOLS) == 15
