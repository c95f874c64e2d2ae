"""The headline store with leaves below the day: ``day=/bucket=`` (SNK-2, SNK-3).

A headline's bucket is a hash of its (day, symbol, headline) digest, so a repeat always meets
its first copy in one leaf.  A merge reads the leaves its batch hashes to and rewrites those
that get a novel row; a write-back rewrites those in which a label or flag changes.  The other
leaves keep their files.  Work grows with the batch and the leaves it touches, not with the day.

The touched leaves are a table of (day, bucket), at most days x ``buckets`` rows, a bound set by
the layout and not by the volume; joined by broadcast it prunes the store's folders.  Choose
``buckets`` so that a leaf of a busy day is one or a few files; the number belongs to the store
and must not change between runs.

Writes go by dynamic overwrite of whole leaves, exchanged when the job commits, so a retried task
reads the old files still and a replayed run writes the same leaves.  Which leaves change is found
without the text.

The store may be a keyed one (``store.add_headlines``, ``store.with_texts``): its rows hold the digests
of their headlines, and a store's rows are either all keyed or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import digest, headline_col
from ..schemas import HEADLINES, KEYED_HEADLINES
from ..session import staged
from .store import _read_or_empty, is_keyed, stored_cols

BUCKETS = 16
BUCKETED = T.StructType([*HEADLINES.fields, T.StructField("bucket", T.IntegerType())])
KEYED_BUCKETED = T.StructType([*KEYED_HEADLINES.fields, T.StructField("bucket", T.IntegerType())])


def bucket_of(buckets: int = BUCKETS, key: str | None = None, headline: str = "headline") -> Column:
    """The leaf of a headline row; ``key`` names a column with its (day, symbol, headline) digest."""
    return F.pmod(F.xxhash64(F.col(key) if key else digest("day", "symbol", headline)), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str, keyed: bool = False) -> DataFrame:
    """The store's rows with their ``bucket`` (empty when absent)."""
    return _read_or_empty(spark, path, KEYED_BUCKETED if keyed else BUCKETED)


def leaves(df: DataFrame) -> DataFrame:
    """The distinct (day, bucket) of a frame, marked for broadcast: a pruning set."""
    return F.broadcast(df.select("day", "bucket").distinct())


def write_leaves(df: DataFrame, path: str) -> None:
    """Replace the leaves that ``df`` (with ``bucket``) has rows of; others stay as they are."""
    (df.select(*stored_cols(df), "bucket").hint("rebalance", "day", "bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("day", "bucket").parquet(path))


def write_buckets(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """First write of a store."""
    write_leaves(df.withColumn("bucket", bucket_of(buckets, headline=headline_col(df))), path)


def upsert_buckets(spark: SparkSession, path: str, batch: DataFrame, as_of, buckets: int = BUCKETS) -> None:
    """Merge a batch (first copies, new to their day) and rewrite the leaves that get a row."""
    from ..operators.merge import novel_firsts, to_record
    keyed = is_keyed(batch)
    batch = batch.withColumn("bucket", bucket_of(buckets, headline=headline_col(batch)))
    here = read_buckets(spark, path, keyed).join(leaves(batch), ["day", "bucket"], "left_semi")
    added = to_record(novel_firsts(batch, here), as_of).select(*stored_cols(batch), "bucket")
    with staged(added, "novel") as new:
        kept = read_buckets(spark, path, keyed).join(leaves(new), ["day", "bucket"], "left_semi")
        write_leaves(kept.unionByName(new), path)


def write_labels_buckets(spark: SparkSession, path: str, labels: DataFrame, mode: str = "all", buckets: int = BUCKETS,
                         keyed: bool = False) -> None:
    """Write labels back and rewrite the leaves in which something changed.

    ``labels`` holds the identity columns (or the digests of ``label_keys``) and ``label`` of scored
    records, as ``apply_labels`` takes them; ``keyed``: the store is a keyed one."""
    from ..operators.sentiment import MATCH_KEY, apply_labels
    labels = labels.withColumn("bucket", bucket_of(buckets, MATCH_KEY if MATCH_KEY in labels.columns else None, headline_col(labels)))
    here = read_buckets(spark, path, keyed).join(leaves(labels), ["day", "bucket"], "left_semi")
    was = here.withColumns({"_processed": F.col("processed"), "_labelled": F.col("labelled")})
    now = apply_labels(was, labels, mode)
    changed = now.where(~(F.col("processed").eqNullSafe(F.col("_processed")) & F.col("labelled").eqNullSafe(F.col("_labelled"))))
    with staged(changed.select("day", "bucket").distinct(), "changed-leaves") as touched:  # no text in this plan
        # the leaves are chosen before the join, so rows of the others are not shuffled
        write_leaves(apply_labels(here.join(leaves(touched), ["day", "bucket"], "left_semi"), labels, mode), path)
