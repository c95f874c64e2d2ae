"""Suffix ranks of many strings by the difference-cover algorithm, distributed.

``suffix_ranks`` takes strings of integer letters as rows ``(sid, j, name, step, span)``.  The
suffixes at places that are 1 or 2 modulo 3 are the sample: their letter triples are sorted
and named, and where names repeat the strings of names are ranked by recursion (each string
gives two, one per residue; ``j div 3`` is the place in it).  The other suffixes are merged
in: among themselves and with residue 1 they sort by (letter, rank of the next suffix), with
residue 2 by (two letters, rank of the one behind them), all of which are known; how many
sampled suffixes come before one is the sum of both counts.

Only order up to a depth is asked for: ``span`` is how many units a letter covers and ``step``
how far the next one is (letters may overlap).  The recursion ends as soon as every repeated
name covers ``depth`` units.  Suffixes equal that
far may then come in any order, but stand together.

Every sort is a range partitioning by the whole key and the row's place, so equal keys may
fill several partitions; ranks are counted inside a partition and moved by what the
partitions before hold, which takes one row per partition.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, shuffle_partitions, stage


PART_ROWS = 200_000  # rows of a sort's partition at least, while there are more partitions than that


def _differs(column: pa.Array, last) -> np.ndarray:
    """Whether each value differs from the one before it (``last``: the one before the first)."""
    out = np.empty(len(column), bool)
    out[0] = last is None or column[0].as_py() != last
    if len(column) > 1:
        out[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return out


def ranked(df: DataFrame, keys: list[str], place: list[str], weight: Column | None = None, name: str = "ranked",
           rows: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``before``, the weight (1 by default) of all rows whose ``keys`` are smaller,
    and ``again``, true for a row that has an equal one before it.  ``place`` tells rows apart,
    ``rows`` is about how many there are, ``keep`` the columns that are returned (all by default)."""
    keep = keep or df.columns
    order = [*keys, *place]
    src = df.withColumn("__w", F.lit(1).cast("long") if weight is None else weight.cast("long"))
    n = shuffle_partitions(df.sparkSession)
    if rows is not None:
        n = max(1, min(n, math.ceil(rows / PART_ROWS)))
    dealt = src.repartitionByRange(n, *order).sortWithinPartitions(*order)

    written = {*keep, "__w"}

    def number(batches):
        part = TaskContext.get().partitionId()
        last, total, start, runs, row = [None] * len(keys), 0, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for c, v in zip(columns, last):
                new |= _differs(c, v)
            w = batch.column("__w").to_numpy()
            before = total + np.cumsum(w) - w
            run = runs + np.cumsum(new)
            starts = np.concatenate([[start], before[new]])[run - runs]
            ends = np.zeros(len(w), bool)  # keys are written where partitions meet only, unless they are asked for
            ends[[0, -1]] = True
            out = [c if f in written else pc.if_else(pa.array(ends), c, pa.scalar(None, c.type)) for f, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(np.full(len(w), part, np.int32)), pa.array(starts), pa.array(run == 1), pa.array(~new),
                 pa.array(row + np.arange(len(w)))], names=[*batch.schema.names, "__part", "__start", "__first", "again", "__row"])
            last, total, start = [c[-1].as_py() for c in columns], total + int(w.sum()), int(starts[-1])
            runs, row = int(run[-1]), row + len(w)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    table = stage(dealt.mapInArrow(number, fields + ", __part int, __start long, __first boolean, again boolean, __row long"), name)
    key = F.struct(*keys)
    heads = table.groupBy("__part").agg(
        F.sum("__w").alias("total"), F.min_by(key, "__row").alias("head"), F.max_by(key, "__row").alias("tail"),
        F.max_by("__start", "__row").alias("tail_start"), F.max_by("__first", "__row").alias("single"))
    # one row per partition from here on
    ring = Window.orderBy("__part")
    heads = (heads.withColumn("__offset", F.sum("total").over(ring) - F.col("total"))
             .withColumn("joins", F.coalesce(F.lag("tail").over(ring) == F.col("head"), F.lit(False)))
             .withColumn("own", F.when(~(F.col("single") & F.col("joins")), F.col("__offset") + F.col("tail_start")))
             .withColumn("carried", F.last("own", ignorenulls=True).over(ring.rowsBetween(Window.unboundedPreceding, -1))))
    heads = heads.select("__part", "__offset", "joins", "carried")
    joined = table.join(F.broadcast(heads), "__part")
    goes_on = F.col("__first") & F.col("joins")
    return joined.select(*keep, F.when(goes_on, F.col("carried")).otherwise(F.col("__offset") + F.col("__start")).alias("before"),
                         (F.col("again") | goes_on).alias("again"))


def suffix_ranks(letters: DataFrame, depth: int) -> DataFrame:
    """``letters(sid, j, name, step, span)``, names from 1 on, places from 0 on -> ``(sid, j, rank)``, written."""
    with scratch(letters.sparkSession):
        return stage(_ranks(letters, depth), "suffix-ranks", outer=True)


def _ranks(letters: DataFrame, depth: int) -> DataFrame:
    at = Window.partitionBy("sid").orderBy("j")
    far = F.lit(depth).cast("long")  # behind a string's end nothing differs any more
    base = stage(letters.select(
        "sid", "j", "name", F.lead("name", 1, 0).over(at).alias("name1"), F.lead("name", 2, 0).over(at).alias("name2"),
        (F.col("step") + F.coalesce(F.lead("step", 1).over(at) + F.coalesce(F.lead("span", 2).over(at), far), far)).alias("span"),
        (F.col("step") + F.coalesce(F.lead("step", 1).over(at), far) + F.coalesce(F.lead("step", 2).over(at), far)).alias("step")), "dc-base")
    rows = base.count()
    residue = F.col("j") % 3
    triples = ranked(base.where(residue != 0), ["name", "name1", "name2"], ["sid", "j"], name="dc-triples", rows=rows,
                     keep=["sid", "j", "step", "span"])
    named = triples.select("sid", "j", (F.col("before") + 1).alias("rank"), "step", "span", "again")
    if named.where(F.col("again") & (F.col("span") < far)).limit(1).count():
        lower = suffix_ranks(named.select((F.col("sid") * 2 + (residue - 1)).alias("sid"), F.expr("j div 3").alias("j"),
                                          F.col("rank").alias("name"), "step", "span"), depth)
        sampled = lower.select(F.expr("sid div 2").alias("sid"), (F.col("j") * 3 + 1 + F.col("sid") % 2).alias("j"), "rank")
    else:
        sampled = named.select("sid", "j", "rank")
    sampled = sampled.withColumn("j", F.col("j").cast("long"))
    with_ranks = base.drop("step", "span", "name2").join(sampled, ["sid", "j"], "left")
    zero = F.lit(0).cast("long")
    known = stage(with_ranks.withColumns({"rank1": F.coalesce(F.lead("rank", 1).over(at), zero),
                                          "rank2": F.coalesce(F.lead("rank", 2).over(at), zero)}), "dc-known")
    with_1 = ranked(known.where(residue != 2).select("sid", "j", "name", "rank1"), ["name", "rank1"], ["sid", "j"],
                    (residue == 1).cast("long"), "dc-merge", rows)
    with_2 = ranked(known.where(residue != 1).select("sid", "j", "name", "name1", "rank2"), ["name", "name1", "rank2"], ["sid", "j"],
                    (residue == 2).cast("long"), "dc-merge", rows, ["sid", "j"])
    none = F.lit(None).cast("long")
    rest = (with_1.where(residue == 0).select("sid", "j", "before", "name", "rank1")
            .unionByName(with_2.where(residue == 0).select("sid", "j", "before", none.alias("name"), none.alias("rank1")))
            .groupBy("sid", "j").agg(F.sum("before").alias("before"), F.max("name").alias("name"), F.max("rank1").alias("rank1")))
    merged = (rest.select("sid", "j", F.col("before").alias("sampled"), F.lit(0).alias("kind"), "name", "rank1")
              .unionByName(known.where(residue != 0).select("sid", "j", (F.col("rank") - 1).alias("sampled"), F.lit(1).alias("kind"),
                                                            zero.alias("name"), zero.alias("rank1"))))
    out = ranked(merged, ["sampled", "kind", "name", "rank1"], ["sid", "j"], name="dc-ranks", rows=rows, keep=["sid", "j"])
    return out.select("sid", "j", (F.col("before") + 1).alias("rank"))
