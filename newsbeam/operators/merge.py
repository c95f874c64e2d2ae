"""Day merge: first occurrence, novelty, feed union, record alignment.

A repeat is the same (day, symbol, headline): case matters, the same text
under another symbol or day is a different headline; null equals null.

Scale notes
-----------
* Rows meet on the 32-byte digest of their key (``functions.keys.digest``), not
  on the text: sorting, grouping and joining compare digests, null keys are
  ordinary digests, and only the winner of a group carries its text.
* ``first_occurrence`` is a grouped ``min(struct(order..., rest...))``, not a
  ``row_number`` window: the aggregate runs a partial (map side) step, so a
  key that holds a third of all rows reaches the shuffle as one row per map
  task instead of being sorted whole inside a single task.
* ``novel`` de-duplicates the stored digests before the anti join, so a key
  stored many times is one row on the build side and no stored text is
  shuffled.  ``novel_firsts`` does both on one partitioning: the batch's text is
  shuffled once.
* Rows may be keyed (``headline_key`` in place of ``headline``, on both sides of a
  merge): then no text is shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_of_lit
from ..functions.keys import digest, headline_col

KEY = ["day", "symbol", "headline"]
RECORD_COLS = ["day", "symbol", "feed", "pos", "headline", "created", "processed", "labelled"]


def day_set(df: DataFrame) -> DataFrame:
    """The distinct days of a frame, marked for broadcast.  It holds one row
    per calendar day, a bound set by the time span rather than the volume;
    joining headline rows to it by broadcast keeps them where they are,
    while a shuffle join on ``day`` would send a whole day to one task.  On
    a day-partitioned table the same join prunes partitions (DPP)."""
    return F.broadcast(df.select("day").distinct())


def _firsts(df: DataFrame, keys=KEY, order=("pos",)) -> DataFrame:
    """The first row of each key by ``order``, with the key's digest ``_k``."""
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in order]
    picked = F.min(F.struct(*order, *rest)).alias("_first")
    out = df.withColumn("_k", digest(*keys)).groupBy("_k").agg(picked)
    return out.select("_k", *[F.col(f"_first.{c}").alias(c) for c in df.columns])


def first_occurrence(df: DataFrame, keys=KEY, order=("pos",)) -> DataFrame:
    """WIN-1 / AGG-3: keep the first row of each key by ``order``."""
    return _firsts(df, keys, order).drop("_k")


def distinct_headlines(df: DataFrame, keys=KEY) -> DataFrame:
    """AGG-3 where any copy will do: the keys themselves, each once."""
    return _firsts(df.select(*keys), keys, ()).drop("_k")


def _key_of(df: DataFrame) -> list[str]:
    """KEY, with the digest of the headline where the rows hold it in place of the text."""
    return ["day", "symbol", headline_col(df)]


def _unknown(keyed: DataFrame, stored: DataFrame, keys) -> DataFrame:
    known = stored.select(digest(*keys).alias("_k")).distinct()
    return keyed.join(known, "_k", "left_anti").drop("_k")


def novel(batch: DataFrame, stored: DataFrame, keys=KEY) -> DataFrame:
    """JN-2: batch rows whose key is not in ``stored``; null equals null, so a
    row with a null key is not added again by every run."""
    return _unknown(batch.withColumn("_k", digest(*keys)), stored, keys)


def novel_firsts(batch: DataFrame, stored: DataFrame, keys=None, order=("pos",)) -> DataFrame:
    """WIN-1 then JN-2: the first copies of a batch that are not in ``stored``."""
    keys = keys or _key_of(batch)
    return _unknown(_firsts(batch, keys, order), stored, keys)


def to_record(df: DataFrame, as_of) -> DataFrame:
    """NST-1: new stored records: ``created`` = run time, not processed, no label."""
    headline = headline_col(df)
    extra = [c for c in df.columns if c not in (*RECORD_COLS, headline, "date_text")]
    return df.select(
        "day", "symbol", "feed", F.col("pos").cast("long").alias("pos"), headline,
        as_of_lit(as_of).alias("created"),
        F.lit(False).alias("processed"),
        F.lit(None).cast("int").alias("labelled"),
        *extra,
    )


def merge_day(stored: DataFrame, batch: DataFrame, as_of, first_write: str = "dedupe") -> DataFrame:
    """SET-2: stored rows, then the batch rows that are new for their day.

    Inside the batch only the first copy of a key is added.  With
    ``first_write="keep_all"`` a day that has no stored rows yet takes the
    batch as it is, repeats included (the parity mode of the first write).
    """
    if first_write == "dedupe":
        added = novel_firsts(batch, stored)
    elif first_write == "keep_all":
        stored_days = day_set(stored)
        fresh = batch.join(stored_days, "day", "left_anti")
        known = batch.join(stored_days, "day", "left_semi")
        added = fresh.unionByName(novel_firsts(known, stored))
    else:
        raise ValueError(f"unknown first_write mode {first_write!r}")
    return stored.unionByName(to_record(added, as_of), allowMissingColumns=True)


def combine_feeds(a: DataFrame, b: DataFrame, order=("pos", "feed")) -> DataFrame:
    """SET-1: both feeds of a run as one set, first copy of each key kept."""
    return first_occurrence(a.unionByName(b, allowMissingColumns=True), KEY, order)


def align_records(old: DataFrame, new: DataFrame) -> DataFrame:
    """NST-2: records of the older shape (no ``labelled``) next to current ones."""
    return old.unionByName(new, allowMissingColumns=True)


def merge_symbol_maps(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """JN-3: align the symbol keys of the stored day and of a batch.

    One row per (day, symbol) present on either side: stored count, added
    count (novel first copies), total, and the smallest / largest headline of
    the merged set.  A batch symbol with nothing new appears with
    ``n_added = 0`` (the empty list the reference adds).  Written as a union
    and one grouped aggregate, so it needs no full outer join and pre-reduces
    hot keys map side.
    """
    stored_keys = stored.select(digest(*KEY).alias("_k")).distinct().withColumn("_stored", F.lit(True))
    flagged = (_firsts(batch).join(stored_keys, "_k", "left")
               .select("day", "symbol", "headline",
                       F.lit(0).alias("_s"),
                       F.when(F.col("_stored").isNull(), 1).otherwise(0).alias("_a")))
    side = stored.select("day", "symbol", "headline", F.lit(1).alias("_s"), F.lit(0).alias("_a"))
    u = side.unionByName(flagged)
    merged_text = F.when((F.col("_s") + F.col("_a")) > 0, F.col("headline"))
    return u.groupBy("day", "symbol").agg(
        F.sum("_s").cast("long").alias("n_stored"),
        F.sum("_a").cast("long").alias("n_added"),
        F.sum(F.col("_s") + F.col("_a")).cast("long").alias("n_total"),
        F.min(merged_text).alias("min_headline"),
        F.max(merged_text).alias("max_headline"),
    )


def merge_symbol_rows(stored: DataFrame, batch: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """JN-3, the merged map itself in long form ``(day, symbol, headline, origin)``.

    ``origin`` is ``stored`` (every stored copy) or ``added`` (first copies new
    to their day).  A (day, symbol) of ``universe`` that neither side holds is
    the map's empty list: one row with null headline and origin.
    """
    added = novel_firsts(batch, stored)
    rows = (stored.select(*KEY, F.lit("stored").alias("origin"))
            .unionByName(added.select(*KEY, F.lit("added").alias("origin"))))
    if universe is None:
        return rows
    # a symbol of either side has rows, so its presence is read off the inputs, without their text
    pairs = stored.select("day", "symbol").unionByName(batch.select("day", "symbol")).distinct()
    empty = novel(universe.select("day", "symbol").distinct(), pairs, ["day", "symbol"])
    none = F.lit(None).cast("string")
    return rows.unionByName(empty.select("day", "symbol", none.alias("headline"), none.alias("origin")))
