"""Sinks: the headline store partitioned by day, label write-back, snapshots.

* Writes use dynamic partition overwrite: only the days present in the
  written frame are replaced, an empty frame changes nothing, and a retried
  job rewrites the same folders (idempotent).  One writer per day: both
  feeds are combined before the write instead of racing on the same day.
* A merge reads the day it then replaces.  Spark writes the new files to a
  folder of their own and exchanges the days when the job commits, after the
  last task, so a retried task reads the old files still and the rows need
  no copy beside the store.
* Snapshots are partitioned by their run key, so replaying a run replaces
  its own snapshot instead of appending a second copy.
* A keyed store is for headlines that many rows show: its rows hold
  ``headline_key`` (the digest), ``<store>_headlines`` holds every text once.
  Merges and write-backs read and rewrite rows without text; ``with_texts``
  joins the texts to what is read.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_of_lit
from ..functions.keys import HEADLINE_KEY, headline_col
from ..session import staged
from ..schemas import DAY_SYMBOLS, HEADLINE_TEXTS, HEADLINES, KEYED_HEADLINES, SCORES_SNAPSHOT
from .tables import read_day

HEADLINE_COLS = [f.name for f in HEADLINES.fields]


def stored_cols(df: DataFrame) -> list[str]:
    """The store's columns, as the rows to write have them (keyed or not)."""
    return [headline_col(df) if c == "headline" else c for c in HEADLINE_COLS]


def is_keyed(df: DataFrame) -> bool:
    return headline_col(df) == HEADLINE_KEY


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A parquet table with a fixed schema; an empty frame while it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_store(spark: SparkSession, path: str, keyed: bool = False) -> DataFrame:
    """The headline store with its fixed schema (empty when absent); ``keyed``: the rows of a keyed store."""
    return _read_or_empty(spark, path, KEYED_HEADLINES if keyed else HEADLINES)


def headlines_path(path: str) -> str:
    return path.rstrip("/") + "_headlines"


def read_headlines(spark: SparkSession, path: str) -> DataFrame:
    """The texts of a keyed store, ``(headline_key, headline)``."""
    return _read_or_empty(spark, headlines_path(path), HEADLINE_TEXTS)


def add_headlines(spark: SparkSession, path: str, texts: DataFrame, batch: DataFrame) -> None:
    """Add those of ``texts`` (``headline_key, headline``) that keyed rows of ``batch`` show and the store does not
    hold yet, each once.  A replayed batch finds its texts there and adds nothing."""
    missing = (batch.select(HEADLINE_KEY).distinct()
               .join(read_headlines(spark, path).select(HEADLINE_KEY), HEADLINE_KEY, "left_anti"))
    (texts.select(HEADLINE_KEY, "headline").join(missing, HEADLINE_KEY, "left_semi")
     .groupBy(HEADLINE_KEY).agg(F.first("headline").alias("headline"))
     .write.mode("append").option("compression", "zstd").parquet(headlines_path(path)))


def with_texts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Rows of a keyed store with ``headline`` in place of ``headline_key``."""
    return rows.join(read_headlines(spark, path), HEADLINE_KEY, "left").drop(HEADLINE_KEY)


def write_day(df: DataFrame, path: str) -> None:
    """SNK-1 / SNK-2 / FLT-5: replace the written days, leave the others.

    ``REBALANCE(day)`` lets adaptive execution size the writer tasks: small
    days are coalesced into few files, and a day holding a large share of
    the rows is split over several tasks (never one task per day).
    """
    (df.select(*stored_cols(df))
     .hint("rebalance", "day")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd")
     .partitionBy("day")
     .parquet(path))


def upsert_days(spark: SparkSession, path: str, batch: DataFrame, as_of,
                first_write: str = "dedupe") -> None:
    """Merge a batch into the days it touches and rewrite only those days."""
    from ..operators.merge import day_set, merge_day
    stored = read_store(spark, path, is_keyed(batch))
    touched = stored.join(day_set(batch), "day", "left_semi")  # partition-pruned, no shuffle
    write_day(merge_day(touched, batch, as_of, first_write), path)


def upsert_day(spark: SparkSession, path: str, batch: DataFrame, day, as_of,
               first_write: str = "dedupe") -> None:
    """The same for one day (the reference's unit of work)."""
    upsert_days(spark, path, read_day(batch, day), as_of, first_write)


def write_labels(spark: SparkSession, path: str, labels: DataFrame, mode: str = "all", keyed: bool = False) -> None:
    """SNK-3: apply labels to the stored days they touch, rewrite those days (``keyed``: of a keyed store)."""
    from ..operators.merge import day_set
    from ..operators.sentiment import apply_labels
    stored = read_store(spark, path, keyed)
    touched = stored.join(day_set(labels), "day", "left_semi")
    write_day(apply_labels(touched, labels, mode), path)


def read_day_symbols(spark: SparkSession, path: str) -> DataFrame:
    """The symbols of each day, with or without headlines (E9, E17)."""
    return _read_or_empty(spark, path, DAY_SYMBOLS)


def upsert_day_symbols(spark: SparkSession, path: str, seen: DataFrame, order: DataFrame | None = None) -> None:
    """Add the (day, symbol) pairs of a batch to the days it touches.

    ``order`` (``symbol, ord``) gives the key order used to break score ties.
    """
    from ..operators.merge import day_set
    old = read_day_symbols(spark, path).join(day_set(seen), "day", "left_semi")
    new = seen.select("day", "symbol").distinct()
    if order is not None:
        new = new.join(order.select("symbol", "ord"), "symbol", "left")
    else:
        new = new.withColumn("ord", F.lit(None).cast("int"))
    merged = (old.unionByName(new.select("day", "symbol", "ord"))
              .groupBy("day", "symbol").agg(F.min("ord").alias("ord")))
    with staged(merged.select("day", "symbol", "ord"), "day-symbols") as m:
        m.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def append_snapshot(ranked: DataFrame, path: str, as_of) -> None:
    """SNK-4: add one score snapshot ``(created, day, rank, symbol, score)``."""
    run_key = F.date_format(as_of_lit(as_of), "yyyyMMdd'T'HHmmss.SSSSSS")
    (ranked.select(as_of_lit(as_of).alias("created"), "day", "rank", "symbol", "score")
     .withColumn("run", run_key)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "day").parquet(path))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots; none written yet gives an empty frame (E19)."""
    cols = [f.name for f in SCORES_SNAPSHOT.fields]
    return _read_or_empty(spark, path, SCORES_SNAPSHOT).select(*cols)


def store_path(base: str, name: str) -> str:
    return os.path.join(base, name)
