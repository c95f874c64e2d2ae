"""Answer memo: a model sees each distinct prompt once (UDF-2).

Answers are kept in a table addressed by content, ``(prompt_key, answer)`` with the digest
of the prompt as key, one folder per run.  Scoring a frame takes its distinct prompts
(a grouped first value with a map-side step, so a headline repeated by a third of the rows
is one row per task), leaves out those the memo knows (anti join on 32-byte digests, no
text), runs the model on the rest and writes their answers; then every row gets its answer
by a join on the digest.  Rows keep their place: the text is neither a key nor shuffled
for the model more than once per distinct prompt.

A run writes under its own ``run`` folder by overwrite, so a retried run replaces its own
answers.  The memo belongs to one model; another model takes another path.  A null text
has no prompt and gets a null answer; a model that answers nothing for a prompt is not
asked again (the null answer is kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import parse_answer, render_prompt
from ..functions.keys import digest
from ..schemas import ANSWER_MEMO
from ..session import arrow_batches, materialize
from ..sources.store import _read_or_empty
from .sentiment import _generated

#: Records and bytes of an Arrow batch of prompts.  Python holds a batch several times over (Arrow, strings, the
#: generated text); a worker's memory follows the batch, not the task's share of the prompts.
PROMPT_BATCH = (1024, "4m")


def read_memo(spark: SparkSession, path: str) -> DataFrame:
    """The known answers ``(prompt_key, answer, run)``; empty while none was written."""
    return _read_or_empty(spark, path, ANSWER_MEMO)


def new_prompts(df: DataFrame, memo: DataFrame, text_col: str = "headline") -> DataFrame:
    """Distinct prompts of ``df`` that ``memo`` has no answer for: ``(prompt_key, prompt)``."""
    asked = df.where(F.col(text_col).isNotNull()).select(digest(text_col).alias("prompt_key"), F.col(text_col).alias("_text"))
    once = asked.groupBy("prompt_key").agg(F.first("_text").alias("_text"))  # equal digests are equal texts
    known = memo.select("prompt_key").distinct()
    return once.join(known, "prompt_key", "left_anti").select("prompt_key", render_prompt("_text").alias("prompt"))


def fill_memo(df: DataFrame, memo_path: str, factory, run: str, text_col: str = "headline", max_length: int = 512,
              partitions: int | None = None) -> None:
    """Ask the model for the prompts of ``df`` that the memo lacks and keep its answers."""
    spark = df.sparkSession
    others = read_memo(spark, memo_path).where(F.col("run") != F.lit(run))
    todo = new_prompts(df, others, text_col)
    if partitions:  # model time dominates: spread the prompts, not the rows they came from
        todo = todo.repartition(partitions)
    answered = todo.select("prompt_key", parse_answer(_generated(F.col("prompt"), factory, max_length)).alias("answer"))
    with arrow_batches(spark, *PROMPT_BATCH):
        (answered.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run").parquet(memo_path))


def recall(df: DataFrame, memo: DataFrame, text_col: str = "headline") -> DataFrame:
    """``df`` with the memo's ``answer``."""
    known = memo.select("prompt_key", "answer")
    keyed = df.withColumn("prompt_key", F.when(F.col(text_col).isNotNull(), digest(text_col)))
    return keyed.join(known, "prompt_key", "left").drop("prompt_key")


class MemoScorer:
    """A scorer that asks ``factory``'s model only for prompts without an answer in the table at
    ``path``; ``run`` names the folder that this run's answers go to."""

    def __init__(self, factory, path: str, run: str, max_length: int = 512, partitions: int | None = None):
        self.factory, self.path, self.run = factory, path, run
        self.max_length, self.partitions = max_length, partitions

    def score(self, df: DataFrame, text_col: str = "headline") -> DataFrame:
        fill_memo(df, self.path, self.factory, self.run, text_col, self.max_length, self.partitions)
        return recall(df, read_memo(df.sparkSession, self.path), text_col)


def memo_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The memo as a table that later runs do not change."""
    return materialize(read_memo(spark, path), "memo")
