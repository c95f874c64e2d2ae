"""Mixing sources to target weights by capped water-filling (operator 4, native).

Every source has a weight and may be repeated at most ``max_epochs`` times.
The total is shared by weight; a source whose share is above its cap is clamped
there and its excess is shared again by weight among the others, until none is
above.  With the sources ordered by saturation level (cap / weight) the clamped
ones are a prefix of the order, so the water level is the first one that does
not exceed the next source's saturation level.

A source's target of ``t`` words is then drawn as whole repetitions of every
document (``t div size``) plus a seeded fraction: documents in the order of a
keyed digest are taken until the remaining words are reached, and the document
that crosses the line is taken in part, so the words taken equal the rounded
target exactly.  No document exceeds ``max_epochs`` times its size.

Scale: the text is read once, (document, size) is staged; per-source sums have
a map-side step; the running sum inside a source goes in two steps, over 4096
digest ranges and inside each range, so a hot source is spread over 4096
groups.  Only one row per source enters the water-filling.

Edge cases: null text has size 0; the null source is a source of its own, last
in order; a source of size 0 has target 0; repeated rows are taken one by one;
empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

MAX_EPOCHS = 3
CYCLE = (5.0, 2.0, 1.0)  # weights of the sources in code-point order, repeating


def words(text: Column) -> Column:
    """Number of maximal runs outside space, tab, line feed, vertical tab, form feed, return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cycle_weights(sizes: DataFrame, cycle=CYCLE) -> DataFrame:
    """``(source, source_size, weight)``: weights repeat along the sources in code-point order, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(rank, F.lit(len(cycle))) + 1).cast("int"))
    return sizes.select("source", "source_size", pick.alias("weight"))


def water_fill(weighted: DataFrame, total: Column | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, weight)`` -> the same with ``target``; one row per source."""
    every = Window.partitionBy(F.lit(0))
    up_to = Window.orderBy("level", F.col("source").asc_nulls_last())
    done = up_to.rowsBetween(Window.unboundedPreceding, -1)
    rest = up_to.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = (F.col("source_size") * max_epochs).cast("double")
    w = weighted.withColumn("cap", cap).withColumn("level", F.col("cap") / F.col("weight"))
    w = w.withColumn("whole", (total if total is not None else F.sum("source_size").over(every)).cast("double"))
    w = w.withColumn("left", F.col("whole") - F.coalesce(F.sum("cap").over(done), F.lit(0.0)))
    w = w.withColumn("open", F.sum("weight").over(rest))
    # the water level if this source and all later ones stay open; the first that holds is the level
    holds = F.col("left") / F.col("open") <= F.col("level")
    first = F.min(F.when(holds, F.struct("level", F.col("source").isNull().alias("last"), "source", "left", "open"))).over(every)
    w = w.withColumn("at", first)
    share = F.col("at.left") * F.col("weight") / F.col("at.open")
    return w.select("source", "source_size", "weight",
                    F.when(F.col("at").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), share)).alias("target"))


def _digest(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix_plan(sizes: DataFrame, weights=cycle_weights, max_epochs: int = MAX_EPOCHS, seed: int = 0) -> DataFrame:
    """``sizes(doc_id, source, size)``, a stored table -> one row per source and
    digest range: the words ahead of the range, the source's size, target, whole
    repetitions and remaining words.  ``weights`` maps source sizes to weights."""
    ranges = (sizes.withColumn("p_range", F.substring(_digest(seed), 1, 3)).groupBy("source", "p_range").agg(F.sum("size").alias("words")))
    ranges = stage(ranges, "mix-ranges")
    sized = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = (water_fill(weights(sized), max_epochs=max_epochs)
               .withColumn("t", F.round("target").cast("long"))
               .withColumn("whole", F.when(F.col("source_size") > 0, F.expr("t div source_size")).otherwise(F.lit(0).cast("long")))
               .withColumn("rest", F.col("t") - F.col("whole") * F.col("source_size")))
    before = Window.partitionBy("source").orderBy("p_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "p_range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    return ranges.alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source")).select(
        F.col("r.source").alias("p_source"), "p_range", "start", "source_size", "target", "whole", "rest")


def mix_apply(docs: DataFrame, plan: DataFrame, seed: int = 0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` with doc_id, source and size -> its columns with source_size,
    target, whole, part and taken (= whole * size + part, in words)."""
    inside = Window.partitionBy("source", "__range").orderBy("__digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = docs.withColumn("__digest", _digest(seed)).withColumn("__range", F.substring("__digest", 1, 3))
    d = d.withColumn("__ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(plan, F.expr("__range = p_range AND source <=> p_source"))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("start") - F.col("__ahead")))
    return (d.withColumn("part", part).withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
            .select(*docs.columns, "source_size", "target", "whole", "part", "taken"))


def repeat_rows(docs: DataFrame, weights=cycle_weights, max_epochs: int = MAX_EPOCHS, seed: int = 0) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, text, source, ...) as often as
    they are taken; the one document per source that is taken in part last is cut
    behind its last word taken.  Columns as given; ``n_chars`` follows the cut."""
    cols = docs.columns
    sizes = stage(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "mix-sizes")
    d = docs.select(F.struct(*cols).alias("__row"), F.col("doc_id"), F.col("source"), words(F.col("text")).alias("size"))
    d = mix_apply(d, mix_plan(sizes, weights, max_epochs, seed), seed)
    copies = F.concat(F.array_repeat("size", F.col("whole").cast("int")),
                      F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<bigint>")))
    d = d.select("__row", "size", F.explode(copies).alias("__take"))
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("__row.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), F.col("__take").cast("int")), "")
    cut = F.col("__take") < F.col("size")
    out = []
    for c in cols:
        v = F.col("__row")[c]
        if c == "text":
            v = F.when(cut, head).otherwise(v)
        elif c == "n_chars":
            v = F.when(cut, F.length(head)).otherwise(v).cast(docs.schema[c].dataType)
        out.append(v.alias(c))
    return d.select(*out)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words(F.col("text")).alias("size"))
    docs = stage(docs, "mix-sizes")
    return mix_apply(docs, mix_plan(docs)).select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(docs: str = "documents", seed: int = 0, max_epochs: int = MAX_EPOCHS) -> str:
    """DuckDB SQL of the mix over a relation ``docs(doc_id, text, source, ...)``:
    columns doc_id, size, source, source_size, target, whole, part, taken."""
    return rf"""
SELECT z.*, whole * size + part AS taken FROM (
 SELECT m.*, greatest(0, least(size, rest - coalesce(sum(size) OVER (PARTITION BY source ORDER BY digest, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS part FROM (
  SELECT d.*, s.source_size, s.target,
         CASE WHEN s.source_size > 0 THEN round(s.target)::BIGINT // s.source_size ELSE 0 END AS whole,
         round(s.target)::BIGINT - (CASE WHEN s.source_size > 0 THEN round(s.target)::BIGINT // s.source_size ELSE 0 END) * s.source_size AS rest
  FROM (SELECT *, md5('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS digest,
               coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}) d
  JOIN (
   SELECT source, source_size, CASE WHEN lvl IS NULL THEN cap ELSE least(cap, lvl.lft * weight / lvl.opn) END AS target FROM (
    SELECT *, min(CASE WHEN lft / opn <= level THEN {{'level': level, 'n': n, 'lft': lft, 'opn': opn}} END) OVER () AS lvl FROM (
     SELECT *, whole_sum - coalesce(sum(cap) OVER (ORDER BY level, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
            sum(weight) OVER (ORDER BY level, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS opn FROM (
      SELECT *, cap / weight AS level, (sum(source_size) OVER ())::DOUBLE AS whole_sum FROM (
       SELECT source, source_size, ({max_epochs} * source_size)::DOUBLE AS cap, n,
              CASE (n - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM (
        SELECT source, sum(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0))::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) AS n
        FROM {docs} GROUP BY source))))) ) s ON d.source IS NOT DISTINCT FROM s.source) m) z
"""


OP4_SQL = f"SELECT doc_id, size, source_size, target, taken FROM ({mix_sql()})"
