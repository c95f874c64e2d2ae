"""The recurring job as Spark jobs: ingest, score, and the endless cycle.

    spark-submit job.py seeds  --out U --base-a A --base-b B
    spark-submit job.py ingest --pages P --store S [--as-of T] [--feeds a,b] [--rule R] [--quarantine Q]
    spark-submit job.py score  --store S --snapshots N [--as-of T] [--only-unprocessed] [--memo M]
    spark-submit job.py run    --landing L --store S --snapshots N --checkpoint C [options of both]

Pages arrive landed as ``(symbol, feed, url, html)`` (fetching is outside
the engine).  ``ingest`` extracts both feeds' items, keeps feed A's recent
ones and feed B's items of the run's day, quarantines what cannot be
judged, merges both feeds into the touched day partitions (one writer per
day).  ``score`` labels the day's headlines, writes labels back, ranks
symbols by net score and appends a snapshot.  ``run`` does both for every
new landing of pages on a 60 second trigger.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import operators as op
from .session import staged
from .schemas import LANDED_PAGES
from .sources import read_raw_pages, store

# The seed list in key order, and each ticker's slug on the
# feed A site.
SYMBOLS = ["BTC", "XRP", "ETH", "BNB", "DOGE", "ADA", "SOL", "TRX", "LTC", "MATIC",
           "DOT", "SHIB", "BCH", "UNI", "AVAX"]
SLUGS = {"BTC": "bitcoin", "XRP": "xrp", "ETH": "ethereum", "BNB": "bnb", "DOGE": "dogecoin",
         "ADA": "cardano", "SOL": "solana", "TRX": "tron", "LTC": "litecoin", "MATIC": "polygon",
         "DOT": "polkadot", "SHIB": "shiba-inu", "BCH": "bitcoin-cash", "UNI": "uniswap",
         "AVAX": "avalanche"}


@dataclass(frozen=True)
class Feed:
    name: str
    headline_css: str
    date_css: str
    rule: str  # "strict30" / "lenient" / "within" on relative ages, "same_day" on day text
    minutes: int = 30  # of "within"


# The CSS selectors of the two feeds' symbol pages (production
# feed A, feed B) and of the older feed A page.
FEED_A = Feed("A", "div.sc-aef7b723-0.dDQUel.news_title h5.sc-16891c57-0.fmcNVa.base-text",
              "span.sc-16891c57-0.dZnbgJ.base-text", "strict30")
FEED_B = Feed("B", "a.Box-sc-1hpkeeg-0.hBnhmi h6.typography__StyledTypography-sc-owin6q-0.fkaXgH",
              "div.searchstyles__DateWrapper-sc-ci5zlg-24.iQeyNE h6.typography__StyledTypography-sc-owin6q-0.fQGhGk",
              "same_day")
FEED_A_OLD = Feed("A", "div.sc-4478c964-2.dzSRu h3.sc-aba8b85a-0.jPQZtg",
                  "span.sc-4984dd93-0.sc-4478c964-12.hQygdF", "lenient")


def seeds(spark: SparkSession, symbols=SYMBOLS, slugs=SLUGS, base_a: str | None = None,
          base_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The URLs to fetch for a run, ``(ord, symbol, feed, url)``, and the
    tickers missing from the slug dimension (quarantine, JN-1)."""
    from .sources.tables import symbol_dim_df, symbols_df
    syms = symbols_df(spark, list(symbols))
    dim = symbol_dim_df(spark, dict(slugs))
    a = op.seed_urls(syms, dim, "slug", base_a).select("ord", "symbol", F.lit("A").alias("feed"), "url")
    b = op.seed_urls(syms, style="search", base=base_b).select("ord", "symbol", F.lit("B").alias("feed"), "url")
    return a.unionByName(b), op.unknown_symbols(syms, dim)


def feed_items(pages: DataFrame, feed: Feed, day: dt.date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept items, quarantine rows, all extracted items) of one feed's pages.

    The extracted items are persisted (the caller unpersists them): kept
    rows, quarantine and the day's symbols all derive from them.
    """
    pages = pages.where(F.col("feed") == feed.name)
    items = (op.extract_headlines(pages, feed.headline_css, feed.date_css, symbol="symbol",
                                  feed=feed.name, id_col="url")
             .withColumn("day", F.lit(day))
             .persist(StorageLevel.MEMORY_AND_DISK))
    missing = op.unpaired_items(items)
    dated = items.where(F.col("date_text").isNotNull())
    if feed.rule == "same_day":
        kept = dated.where(op.is_same_day("date_text", day, "text"))
        bad = dated.where(F.lit(False)).withColumn("reason", F.lit(None).cast("string"))
    else:
        kept, bad = op.split_recent(dated, "date_text", feed.rule, feed.minutes)
    cols = ["day", "reason", "feed", "symbol", "date_text", "headline"]
    return kept, missing.select(*cols).unionByName(bad.select(*cols)), items


def landed(spark: SparkSession, path: str, pages_format: str = "parquet", stream: bool = False) -> DataFrame:
    """Landed pages: a table, or ``html`` files under ``feed=.../symbol=.../`` (``read_raw_pages``)."""
    if pages_format == "html":
        return read_raw_pages(spark, path, stream=stream).drop("charset")
    return spark.readStream.schema(LANDED_PAGES).parquet(path) if stream else spark.read.parquet(path)


def ingest(spark: SparkSession, pages: DataFrame, store_path: str, as_of: dt.datetime,
           feeds=(FEED_A, FEED_B), quarantine_path: str | None = None,
           first_write: str = "dedupe", symbols=SYMBOLS) -> None:
    """Extract, filter and merge all feeds of one run into the store.

    The day's symbols (every symbol with extracted items, before the
    filters, E9) go to ``<store>_symbols`` with their seed order.
    """
    from .sources.tables import symbols_df
    day = as_of.date()
    kept = bad = seen = None
    extracted_frames = []
    for f in feeds:
        k, q, x = feed_items(pages, f, day)
        extracted_frames.append(x)
        kept = k if kept is None else kept.unionByName(k)
        bad = q if bad is None else bad.unionByName(q)
        seen = x if seen is None else seen.unionByName(x)
    names = [f.name for f in feeds]
    none = F.lit(None).cast("string")
    lost = pages.where(F.col("feed").isNull() | ~F.col("feed").isin(names)).select(
        F.lit(day).alias("day"), F.lit("unknown feed").alias("reason"), "feed", "symbol", none.alias("date_text"), F.col("url").alias("headline"))
    bad = bad.unionByName(lost).withColumn("run", F.lit(as_of.strftime("%Y%m%dT%H%M%S.%f")))
    items = kept.select("day", "symbol", "feed", "pos", "headline")
    try:
        store.upsert_days(spark, store_path, items, as_of, first_write)
        store.upsert_day_symbols(spark, symbols_path(store_path), seen, symbols_df(spark, list(symbols)))
        write_quarantine(bad, quarantine_path or store_path.rstrip("/") + "_quarantine")
    finally:
        for x in extracted_frames:
            x.unpersist()


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Rows that cannot be judged, kept per day and run (a replayed run replaces its own)."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "run").parquet(path)


def symbols_path(store_path: str) -> str:
    return store_path.rstrip("/") + "_symbols"


def score(spark: SparkSession, store_path: str, snapshot_path: str, as_of: dt.datetime,
          scorer=None, day: dt.date | None = None, only_unprocessed: bool = False,
          label_mode: str = "exact", write_back: str = "all") -> DataFrame:
    """Score one day (default: the run's day); returns the ranked scores."""
    day = day or as_of.date()
    stored = store.read_day(store.read_store(spark, store_path), day)
    todo = op.unprocessed(stored) if only_unprocessed else stored
    universe = store.read_day(store.read_day_symbols(spark, symbols_path(store_path)), day)
    with staged(op.label_keys(todo, scorer or op.LexiconScorer(), label_mode), "score-labels") as labelled:
        store.write_labels(spark, store_path, labelled, write_back)
        ranked = op.rank_scores(op.net_score(labelled, universe), order_col="ord")
        store.append_snapshot(ranked, snapshot_path, as_of)
    return store.read_day(store.read_snapshots(spark, snapshot_path), day).where(
        F.col("created") == F.lit(as_of).cast("timestamp"))


def run(spark: SparkSession, landing: str, store_path: str, snapshot_path: str, checkpoint: str,
        every: str = "60 seconds", available_now: bool = False, scorer=None, feeds=None,
        quarantine_path: str | None = None, first_write: str = "dedupe", symbols=SYMBOLS,
        only_unprocessed: bool = False, label_mode: str = "exact", write_back: str = "all", pages_format: str = "parquet"):
    """The endless cycle: each new landing of pages is ingested then scored, with the options of both."""
    feeds = feeds or (FEED_A, FEED_B)
    quarantine_path = quarantine_path or store_path.rstrip("/") + "_quarantine"
    from .streaming.cycle import run_cycle
    stream = landed(spark, landing, pages_format, stream=True)

    def cycle(batch: DataFrame, batch_id: int) -> None:
        # a backlog may hold several days: each page counts for the day it landed on
        day = F.to_date("landed_at")
        runs = batch.groupBy(day.alias("day")).agg(F.max("landed_at").alias("as_of")).orderBy("day").collect()
        for r in runs:
            if r["day"] is None:  # no landing time, so no day to count for
                none = F.lit(None).cast("string")
                write_quarantine(batch.where("landed_at IS NULL").select(
                    day.alias("day"), F.lit("no landing time").alias("reason"), "feed", "symbol", none.alias("date_text"),
                    F.col("url").alias("headline"), F.lit(f"batch-{batch_id}").alias("run")), quarantine_path)
                continue
            ingest(spark, batch.where(day == F.lit(r["day"])), store_path, r["as_of"], feeds, quarantine_path, first_write, symbols)
            score(spark, store_path, snapshot_path, r["as_of"], scorer, None, only_unprocessed, label_mode, write_back)

    return run_cycle(stream, cycle, checkpoint, every, available_now)


def _as_of(text: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(text) if text else dt.datetime.now().replace(microsecond=0)


def feeds_of(names: str, rule_a: str | None = None, minutes: int = 60) -> tuple[Feed, ...]:
    """The feeds of a run by name (``a``, ``a_old``, ``b``, with commas); ``rule_a`` sets the recency rule of feed A."""
    known = {"a": FEED_A, "a_old": FEED_A_OLD, "b": FEED_B}
    chosen = [known[n.strip().lower()] for n in names.split(",")]
    return tuple(replace(f, rule=rule_a, minutes=minutes) if rule_a and f.name == "A" else f for f in chosen)


def _ingest_options(p) -> None:
    p.add_argument("--quarantine")
    p.add_argument("--pages-format", choices=("parquet", "html"), default="parquet", help="html: a file per page under feed=.../symbol=.../")
    p.add_argument("--first-write", choices=("dedupe", "keep_all"), default="dedupe")
    p.add_argument("--feeds", default="a,b", help="a, a_old, b (the older jobs: a_old or b alone)")
    p.add_argument("--rule", choices=("strict30", "lenient", "within"), help="recency rule of feed A")
    p.add_argument("--minutes", type=int, default=60, help="of --rule within")


def _score_options(p) -> None:
    p.add_argument("--only-unprocessed", action="store_true")
    p.add_argument("--label-mode", choices=("exact", "contains"), default="exact")
    p.add_argument("--write-back", choices=("all", "first_match"), default="all")
    p.add_argument("--memo", help="table of answers by content: a prompt is given to the model once")


def _scorer(args, run: str):
    return op.MemoScorer(op.lexicon_model(), args.memo, run) if args.memo else op.LexiconScorer()


def main(argv=None) -> None:
    from .session import get_spark
    p = argparse.ArgumentParser(prog="newsbeam.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--pages", required=True)
    a.add_argument("--store", required=True)
    a.add_argument("--as-of")
    _ingest_options(a)
    s = sub.add_parser("score")
    s.add_argument("--store", required=True)
    s.add_argument("--snapshots", required=True)
    s.add_argument("--as-of")
    _score_options(s)
    e = sub.add_parser("seeds")
    e.add_argument("--out", required=True)
    e.add_argument("--base-a", required=True)
    e.add_argument("--base-b", required=True)
    r = sub.add_parser("run")
    for x in ("--landing", "--store", "--snapshots", "--checkpoint"):
        r.add_argument(x, required=True)
    r.add_argument("--every", default="60 seconds")
    r.add_argument("--available-now", action="store_true", help="process what has landed and stop")
    _ingest_options(r)
    _score_options(r)
    args = p.parse_args(argv)
    spark = get_spark(state_store="rocksdb" if args.cmd == "run" else "default")
    if args.cmd == "seeds":
        urls, unknown = seeds(spark, base_a=args.base_a, base_b=args.base_b)
        urls.write.mode("overwrite").parquet(args.out)
        unknown.write.mode("overwrite").parquet(args.out.rstrip("/") + "_unknown_symbols")
    elif args.cmd == "ingest":
        ingest(spark, landed(spark, args.pages, args.pages_format), args.store, _as_of(args.as_of),
               feeds_of(args.feeds, args.rule, args.minutes), args.quarantine, args.first_write)
    elif args.cmd == "score":
        as_of = _as_of(args.as_of)
        score(spark, args.store, args.snapshots, as_of, _scorer(args, as_of.strftime("%Y%m%dT%H%M%S")), only_unprocessed=args.only_unprocessed,
              label_mode=args.label_mode, write_back=args.write_back).orderBy("day", "rank").show(100, False)
    else:
        run(spark, args.landing, args.store, args.snapshots, args.checkpoint, args.every, args.available_now,
            _scorer(args, dt.datetime.now().strftime("%Y%m%dT%H%M%S")), feeds_of(args.feeds, args.rule, args.minutes), args.quarantine,
            args.first_write, SYMBOLS, args.only_unprocessed, args.label_mode, args.write_back, args.pages_format).awaitTermination()


if __name__ == "__main__":
    main()
