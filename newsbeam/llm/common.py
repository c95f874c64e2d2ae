"""Helpers shared by the training-data operators.

``prepare`` makes a session ready for them (shared checkpoint folder, package
on the Python workers), ``stage`` cuts lineage with a table written under the
shared folder, ``successors`` finds every row's neighbour in a global order
without a single-task sort.
"""

from __future__ import annotations

import contextlib
import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsbeam.session import ensure_checkpoint_dir, remove_path, run_dir, ship_package


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: list[list[str]] = []


def stage(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """``df`` written once as a table under the shared checkpoint folder.  Inside ``scratch`` the
    table is removed with the others; with ``outer`` it belongs to the enclosing one."""
    spark = prepare(df.sparkSession)
    path = run_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    owners = _SCRATCH[:-1] if outer else _SCRATCH
    if owners:
        owners[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables staged in the block are removed at its end, and so are the shuffle files of plans
    that nothing refers to any more (Spark drops them once their plan is collected)."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            remove_path(spark, path)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def successors(ids: DataFrame, order: list[Column], keep: list[str], nxt: list[str]) -> DataFrame:
    """Each row's next row in ``order`` (the last row's next is the first).

    ``ids`` holds small columns only; ``keep`` names the columns returned for a
    row and ``nxt`` those returned of its successor as ``next_<name>``.  The
    rows are range-partitioned and written once, so every partition is a
    contiguous run of the order; a window inside each partition finds the
    neighbours, and the first row of each partition (one row per partition)
    closes the gap to the partition before.  No task sees more than its range,
    whatever the ids look like.  Rows equal in ``order`` are interchangeable.
    """
    spark = ids.sparkSession
    n = shuffle_partitions(spark)
    run = stage(ids.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("__part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("__part").orderBy(*order)
    pack = F.struct(*[F.col(c) for c in nxt])
    rows = (run.withColumn("__rn", F.row_number().over(inside))
            .withColumn("__next", F.lead(pack).over(inside))
            .withColumn("__last", F.lead(F.lit(1)).over(inside).isNull()))
    # one row per partition from here on
    heads = rows.where("__rn = 1").select("__part", pack.alias("__head"))
    ring = Window.orderBy("__part")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("__part", F.coalesce(F.lead("__head").over(ring), F.first("__head").over(whole)).alias("__head"))
    out = rows.join(heads, "__part", "left")
    taken = F.when(F.col("__last"), F.col("__head")).otherwise(F.col("__next"))
    out = out.select(*keep, taken.alias("__taken"))
    return out.select(*keep, *[F.col("__taken")[c].alias(f"next_{c}") for c in nxt])
