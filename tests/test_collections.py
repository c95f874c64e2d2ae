"""Per-row map and array scalars of the nested document (SCL-9..13)."""

from pyspark.sql import functions as F

from newsbeam.functions import collections as C


def test_map_scalars(spark):
    df = spark.sql("SELECT map('S', array(named_struct('headline', 'X', 'pos', 0L))) AS m")
    r = df.select(C.map_get_or_empty("m", "S").alias("s"), C.map_get_or_empty("m", "T").alias("t"),
                  C.has_key("m", "S").alias("hs"), C.has_key("m", "T").alias("ht")).first()
    assert [x.headline for x in r.s] == ["X"] and r.t == [] and r.hs and not r.ht


def test_merge_record_lists(spark):
    df = spark.sql("""
      SELECT array(named_struct('headline', 'X', 'pos', 0L)) AS stored,
             array(named_struct('headline', 'X', 'pos', 1L), named_struct('headline', 'Y', 'pos', 2L),
                   named_struct('headline', 'Y', 'pos', 3L), named_struct('headline', 'Z', 'pos', 4L)) AS batch""")
    r = df.select(C.merge_record_lists("stored", "batch").alias("m"),
                  C.field_of("batch", "headline").alias("f"),
                  C.contains_value(C.field_of("stored", "headline"), F.lit("X")).alias("c"),
                  C.append(C.field_of("stored", "headline"), F.lit("W")).alias("a")).first()
    assert [(x.headline, x.pos) for x in r.m] == [("X", 0), ("Y", 2), ("Z", 4)]
    assert r.f == ["X", "Y", "Y", "Z"] and r.c and r.a == ["X", "W"]


def test_merge_record_lists_missing_side(spark):
    df = spark.sql("""
      SELECT CAST(NULL AS array<struct<headline:string,pos:bigint>>) AS stored,
             array(named_struct('headline', 'A', 'pos', 1L), named_struct('headline', 'A', 'pos', 2L)) AS batch""")
    r = df.select(C.merge_record_lists("stored", "batch").alias("m")).first()
    assert [(x.headline, x.pos) for x in r.m] == [("A", 1)]
