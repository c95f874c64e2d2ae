"""Day documents as VARIANT (NST-2, NST-3).

The document store holds records of two shapes side by side: the older one without
``labelled`` and the current one.  A VARIANT column takes both as they are: ``variant_documents``
nests records into day documents whose records keep exactly their own fields, and
``variant_records`` reads them back with one schema, in which a field a record lacks is null.
``variant_shapes`` says which fields the stored records have (schema merging over the documents).

Documents are cut into bounded parts as ``nest_day`` does (``pos div part_size``), so a busy day
is many rows and no list grows with the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import HEADLINE_KEY, headline_col

_FIELDS = (("pos", "long"), ("headline", "string"), ("created", "timestamp"), ("processed", "boolean"), ("labelled", "int"))


def _fields(headline: str):
    """The fields of a record; a keyed one holds the digest of its headline."""
    return [(HEADLINE_KEY, "binary") if (name, headline) == ("headline", HEADLINE_KEY) else (name, kind) for name, kind in _FIELDS]


def variant_documents(records: DataFrame, part_size: int = 100) -> DataFrame:
    """Records of one shape -> ``(day, symbol, feed, part, document)``, ``document`` a VARIANT
    ``{"records": [...]}`` in the order of ``pos``; a record has the fields its frame has."""
    own = [F.col(name) for name, _ in _fields(headline_col(records)) if name in records.columns]
    part = F.floor(F.col("pos") / F.lit(part_size)).cast("long")
    rows = F.array_sort(F.collect_list(F.struct(*own)))
    return (records.withColumn("part", part).groupBy("day", "symbol", "feed", "part")
            .agg(F.to_variant_object(F.struct(rows.alias("records"))).alias("document")))


def variant_records(documents: DataFrame, headline: str = "headline") -> DataFrame:
    """Documents of any shape -> ``(day, symbol, feed, pos, headline, created, processed, labelled)``;
    what a record does not have is null.  ``headline``: the field that stands for it (``headline_key`` in keyed records)."""
    one = documents.select("day", "symbol", "feed", F.explode(F.variant_get("document", "$.records", "array<variant>")).alias("record"))
    return one.select("day", "symbol", "feed", *[F.try_variant_get("record", f"$.{name}", kind).alias(name) for name, kind in _fields(headline)])


def variant_shapes(documents: DataFrame) -> DataFrame:
    """The distinct field lists of the stored records, with how many records have each."""
    one = documents.select(F.explode(F.variant_get("document", "$.records", "array<variant>")).alias("record"))
    fields = F.array_join(F.array_sort(F.json_object_keys(F.to_json("record"))), ",")
    return one.select(fields.alias("fields")).groupBy("fields").agg(F.count("*").alias("records"))
