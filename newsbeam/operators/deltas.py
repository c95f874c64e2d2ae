"""Net scores maintained by signed deltas (AGG-1, STR-2): a view kept up to date, not recounted.

Two append-only tables carry the state of all scored headlines without their texts:

* ``labels``: ``(day, symbol, key, label, batch_id)``, the label a headline got in a batch; its
  label is that of its latest batch.  ``key`` is the digest of (day, symbol, headline).
* ``deltas``: ``(day, symbol, delta, headlines, batch_id)``, per batch and symbol the sum of
  (new label - old label) and how many headlines were new.

A batch reads the labels of its own days only (the day is the folder), compares them with
what it brings, and appends the differences; a headline whose label did not change adds
nothing.  The net score is the sum of the deltas: as many rows as there are batches and
symbols, never the headlines.  A retracted headline (label null in the batch) takes its old
label back out and no longer counts.

Every write replaces its own ``batch_id`` folder, and a batch ignores what it wrote before,
so a replayed batch changes nothing.  Batches are applied in the order of their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import digest
from ..schemas import LABEL_LOG, SCORE_DELTAS
from ..session import staged
from ..sources.store import _read_or_empty
from .merge import day_set
from .sentiment import MATCH_KEY


def read_label_log(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, LABEL_LOG)


def read_deltas(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, SCORE_DELTAS)


def latest_labels(log: DataFrame) -> DataFrame:
    """``(day, symbol, key, label)``: each headline's label of its last batch."""
    last = F.max_by(F.struct("label"), "batch_id").alias("_l")
    return log.groupBy("day", "symbol", "key").agg(last).select("day", "symbol", "key", F.col("_l.label").alias("label"))


def batch_labels(labelled: DataFrame) -> DataFrame:
    """Scored headlines ``(day, symbol, headline, label)``, or those of ``label_keys``, as ``(day, symbol, key, label)``, copies
    of one headline once (the highest label of them).  The text ends here."""
    key = F.col(MATCH_KEY) if MATCH_KEY in labelled.columns else digest("day", "symbol", "headline")
    keyed = labelled.select("day", "symbol", key.alias("key"), "label")
    return keyed.groupBy("day", "symbol", "key").agg(F.max("label").cast("int").alias("label"))


def label_changes(known: DataFrame, batch: DataFrame) -> DataFrame:
    """``(day, symbol, key, old, new)`` of the batch's headlines whose label is new or another one.
    Union and one grouped step, so no side is joined on nullable columns."""
    old = known.select("day", "symbol", "key", F.col("label").alias("_old"), F.lit(None).cast("int").alias("_new"), F.lit(False).alias("_here"))
    new = batch.select("day", "symbol", "key", F.lit(None).cast("int").alias("_old"), F.col("label").alias("_new"), F.lit(True).alias("_here"))
    both = old.unionByName(new).groupBy("day", "symbol", "key").agg(
        F.max("_old").alias("old"), F.max("_new").alias("new"), F.max("_here").alias("_here"))
    return both.where(F.col("_here") & ~F.col("old").eqNullSafe(F.col("new"))).drop("_here")


def score_deltas(changes: DataFrame) -> DataFrame:
    """``(day, symbol, delta, headlines)``: what the changes add to each score and count."""
    zero = F.lit(0)
    return changes.groupBy("day", "symbol").agg(
        F.sum(F.coalesce("new", zero) - F.coalesce("old", zero)).cast("long").alias("delta"),
        F.sum(F.when(F.col("old").isNull(), 1).otherwise(0) - F.when(F.col("new").isNull(), 1).otherwise(0)).cast("long").alias("headlines"))


def apply_batch(spark: SparkSession, labelled: DataFrame, log_path: str, delta_path: str, batch_id: int) -> None:
    """Bring a batch of scored headlines ``(day, symbol, headline, label)`` into both tables."""
    dyn = {"partitionOverwriteMode": "dynamic"}
    number = F.lit(batch_id).cast("long")
    with staged(batch_labels(labelled), "batch-labels") as batch:
        known = (read_label_log(spark, log_path).where(F.col("batch_id") < number)
                 .join(day_set(batch), "day", "left_semi"))  # only the folders of the batch's days are read
        with staged(label_changes(latest_labels(known), batch), "label-changes") as changes:
            (changes.select("day", "symbol", "key", F.col("new").alias("label")).withColumn("batch_id", number)
             .write.mode("overwrite").options(**dyn).partitionBy("day", "batch_id").parquet(log_path))
            (score_deltas(changes).withColumn("batch_id", number)
             .write.mode("overwrite").options(**dyn).partitionBy("batch_id").parquet(delta_path))


def net_from_deltas(deltas: DataFrame, up_to: int | None = None) -> DataFrame:
    """``(day, symbol, score, headlines)`` after all batches, or after batch ``up_to``."""
    if up_to is not None:
        deltas = deltas.where(F.col("batch_id") <= F.lit(up_to))
    return deltas.groupBy("day", "symbol").agg(F.sum("delta").cast("long").alias("score"), F.sum("headlines").cast("long").alias("headlines"))


def delta_cycle(spark: SparkSession, log_path: str, delta_path: str, scorer, label_mode: str = "exact", text_col: str = "headline"):
    """Batch function of a stream (``run_cycle``): the batch's headlines without a label of their
    own in the log are scored and their deltas appended; others are not given to the model."""
    from .sentiment import label_headlines

    def cycle(batch_df: DataFrame, batch_id: int) -> None:
        number = F.lit(batch_id).cast("long")
        items = batch_df.withColumn("key", digest("day", "symbol", text_col))
        known = (read_label_log(spark, log_path).where(F.col("batch_id") < number).join(day_set(items), "day", "left_semi")
                 .select("key").distinct())
        fresh = items.join(known, "key", "left_anti").drop("key")
        apply_batch(spark, label_headlines(fresh, scorer, label_mode, text_col), log_path, delta_path, batch_id)

    return cycle
