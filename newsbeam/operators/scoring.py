"""Net score per symbol and day, ranking, snapshot map.

``net_score`` is a grouped sum: partial aggregation per map task, then one
shuffle on (day, symbol) carrying one row per key and task, so a symbol
with a third of the rows costs no more than any other.  The ranking runs
on the aggregated frame, one window partition per day whose size is the
number of symbols of that day (the seed list), never on headline rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def day_symbols(df: DataFrame) -> DataFrame:
    """The (day, symbol) pairs of a batch: the universe of a day's scores."""
    return df.select("day", "symbol").distinct()


def unprocessed(headlines: DataFrame) -> DataFrame:
    """FLT-6: headlines not scored yet."""
    return headlines.where(~F.col("processed"))


def net_score(labelled: DataFrame, universe: DataFrame | None = None,
              only_unprocessed: bool = False, label_col: str = "label") -> DataFrame:
    """AGG-1 / AGG-2 / FLT-6: sum of labels per (day, symbol).

    With ``universe`` every (day, symbol) of it is kept, 0 when it has no
    headlines, next to every scored one.  ``only_unprocessed`` scores rows not yet processed only.
    """
    src = unprocessed(labelled) if only_unprocessed else labelled
    agg = src.groupBy("day", "symbol").agg(F.sum(label_col).cast("long").alias("score"))
    if universe is None:
        return agg
    extra = [c for c in universe.columns if c not in ("day", "symbol")]
    zero = F.lit(0).cast("long").alias("score")
    # one grouped step instead of an outer join: a null symbol is one symbol, and a scored one that the universe lacks stays
    both = universe.select("day", "symbol", *extra, zero).unionByName(agg, allowMissingColumns=True)
    return (both.groupBy("day", "symbol").agg(*[F.min(c).alias(c) for c in extra], F.sum("score").cast("long").alias("score"))
            .select("day", "symbol", *extra, "score"))


def rank_scores(scores: DataFrame, order_col: str | None = "ord") -> DataFrame:
    """SRT-1: rank 1 = highest score of the day; ties keep key order
    (``ord`` when present, then the symbol)."""
    tie = [F.col(order_col).asc_nulls_last()] if order_col and order_col in scores.columns else []
    w = Window.partitionBy("day").orderBy(F.col("score").desc(), *tie, F.col("symbol").asc())
    return scores.withColumn("rank", F.row_number().over(w).cast("int"))


def snapshot_rows(ranked: DataFrame, as_of) -> DataFrame:
    """SNK-4 rows: ``(created, day, rank, symbol, score)``."""
    from ..functions.dates import as_of_lit
    return ranked.select(as_of_lit(as_of).alias("created"), "day", "rank", "symbol", "score")


def snapshot_map(snapshot: DataFrame) -> DataFrame:
    """AGG-4: one ``symbol -> score`` map per (created, day), entries in rank order.

    A day holds one entry per symbol of the seed list, so the group is small.
    """
    entries = F.array_sort(F.collect_list(F.struct("rank", "symbol", "score")))
    return (snapshot.groupBy("created", "day")
            .agg(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["symbol"], e["score"])))
                 .alias("sentiments")))
