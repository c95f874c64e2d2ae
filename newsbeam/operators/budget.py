"""Batches of equal cost for a model (UDF-2).

A model pads a batch to its longest prompt, so a batch costs rows x longest.  Prompts are
dealt to tasks by their length (range partitioning, so each task has prompts of about one
length, and a length that very many prompts share fills several tasks), sorted inside the
task and cut into batches whose cost stays within ``budget``.  A prompt that alone costs more
is a batch of its own; none is cut or dropped.  The length argument goes to the model, whose
tokenizer knows what it cuts.  ``batch_costs`` reports what was formed.

Length is counted in ``unit`` characters a token (4 by default), as the engine has no
tokenizer of the model.  A null text has no prompt: length 0, a null answer.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import parse_answer, render_prompt

UNIT = 4


def token_length(prompt, unit: int = UNIT) -> Column:
    """An estimate of a prompt's tokens."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.ceil(F.length(p) / F.lit(unit)).cast("int")


def cut_batches(lengths: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """Ascending lengths -> (first, behind the last) of batches of rows x longest <= budget; a row
    that alone is above it is a batch of its own."""
    out, lo = [], 0
    while lo < len(lengths):
        # rows lo..hi-1 cost (hi - lo) * lengths[hi - 1], which only grows with hi
        cost = np.arange(1, len(lengths) - lo + 1) * np.maximum(lengths[lo:], 1)
        hi = lo + max(1, int(np.searchsorted(cost, budget, side="right")))
        out.append((lo, hi))
        lo = hi
    return out


class BudgetedScorer:
    """``factory(max_length)`` as for ``PandasScorer``; the model gets batches of at most ``budget``
    padded tokens (rows x longest prompt)."""

    def __init__(self, factory, budget: int = 16_384, max_length: int = 512, partitions: int | None = None, unit: int = UNIT):
        self.factory, self.budget, self.max_length = factory, budget, max_length
        self.partitions, self.unit = partitions, unit

    def batches(self, df: DataFrame, text_col: str = "headline") -> DataFrame:
        """``df`` with its prompt, answer and batch: columns ``_generated``, ``_part``, ``_batch``, ``_length``."""
        factory, budget, max_length = self.factory, self.budget, self.max_length
        n = self.partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        src = df.withColumn("_prompt", render_prompt(text_col)).withColumn("_length", F.coalesce(token_length("_prompt", self.unit), F.lit(0)))
        dealt = src.repartitionByRange(n, "_length", F.rand(7)).sortWithinPartitions("_length")

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext
            generate = factory(max_length)
            part, number = TaskContext.get().partitionId(), 0
            for frame in frames:
                for lo, hi in cut_batches(frame["_length"].to_numpy(np.int64), budget):
                    rows = frame.iloc[lo:hi].copy()
                    rows["_generated"] = generate(rows["_prompt"]).to_numpy()
                    rows["_part"], rows["_batch"] = part, number
                    number += 1
                    yield rows.drop(columns="_prompt")
        schema = src.drop("_prompt").schema.add("_generated", "string").add("_part", "integer").add("_batch", "integer")
        return dealt.mapInPandas(run, schema)

    def score(self, df: DataFrame, text_col: str = "headline") -> DataFrame:
        out = self.batches(df, text_col)
        return out.withColumn("answer", parse_answer("_generated")).drop("_generated", "_part", "_batch", "_length")


def batch_costs(batches: DataFrame) -> DataFrame:
    """Per batch its rows, its longest prompt and its cost (rows x longest)."""
    per = batches.groupBy("_part", "_batch").agg(F.count("*").alias("n_rows"), F.max("_length").cast("long").alias("longest"))
    return per.select("n_rows", "longest", (F.col("n_rows") * F.col("longest")).alias("cost"))
