"""Nested day document <-> long rows.

The reference keeps one document per day: ``{symbol: [record, ...]}``.  The
store here is long (one row per headline, partitioned by day); the nested
form is a view built from it.  Lists are cut into parts of at most
``part_size`` positions (``pos div part_size``), so no group ever has to
hold a whole hot symbol.  Parts are also split by run and feed
(``part_by``): positions restart on every page, so ``pos`` is unique only
within (day, symbol, created, feed), and there a part holds at most
``part_size`` records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_key_text

KEYS = ("day", "symbol")
PART_BY = ("created", "feed")


def _record_cols(df: DataFrame, part_by) -> list[str]:
    """``pos`` first (the list order), then every other non-key column."""
    return ["pos"] + [c for c in df.columns if c not in (*KEYS, *part_by, "pos", "part")]


def nest_day(records: DataFrame, part_size: int = 1000, day_symbols: DataFrame | None = None,
             part_by=PART_BY) -> DataFrame:
    """NST-3: ``(day, symbol, *part_by, part, records)``, records sorted by ``pos``.

    A record is a struct of every other column (``pos``, ``headline``,
    ``processed``, ``labelled``, ...).  With ``day_symbols`` every listed
    symbol appears; one without headlines gets an empty list (part 0, null
    ``part_by`` values).
    """
    part_by = [c for c in part_by if c in records.columns]
    cols = _record_cols(records, part_by)
    rec = F.struct(*[F.col(c) for c in cols])
    nested = (records.withColumn("part", F.floor(F.col("pos") / F.lit(part_size)).cast("long"))
              .groupBy(*KEYS, *part_by, "part")
              .agg(F.array_sort(F.collect_list(rec)).alias("records")))
    if day_symbols is None:
        return nested
    rec_type = T.ArrayType(records.select(rec.alias("r")).schema["r"].dataType)
    empty = (day_symbols.select(*KEYS).join(nested.select(*KEYS).distinct(), list(KEYS), "left_anti")
             .select(*KEYS, *[F.lit(None).cast(records.schema[c].dataType).alias(c) for c in part_by],
                     F.lit(0).cast("long").alias("part"), F.array().cast(rec_type).alias("records")))
    return nested.unionByName(empty)


def day_documents(nested: DataFrame) -> DataFrame:
    """The reference's document shape per (day, run, feed, part): ``symbol -> records``.

    Each entry is one bounded part; the number of entries is the number of
    symbols of the day, which comes from the seed list.
    """
    part_by = [c for c in nested.columns if c not in (*KEYS, "part", "records")]
    return (nested.groupBy("day", *part_by, "part")
            .agg(F.map_from_entries(F.collect_list(F.struct("symbol", "records")))
                 .alias("symbol_headlines"))
            .withColumn("date", day_key_text("day")))  # the document's key text


def unnest_day(nested: DataFrame) -> DataFrame:
    """NST-4: back to one row per record; a symbol with an empty list keeps
    one row with null record fields (outer explode)."""
    fields = nested.schema["records"].dataType.elementType.fieldNames()
    part_by = [c for c in nested.columns if c not in (*KEYS, "part", "records")]
    return (nested.select(*KEYS, *part_by, F.explode_outer("records").alias("r"))
            .select(*KEYS, *part_by, *[F.col(f"r.{c}").alias(c) for c in fields]))
