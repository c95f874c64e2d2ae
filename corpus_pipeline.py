"""A training corpus from ``documents`` in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes every stage's rows as a table under the shared checkpoint folder and
hands the reread table to the next one.  All stages but the last return the
columns of their input.

1. toxicity: documents that the ordinal model rejects go; it is fitted on the
   labelled rows of the stage's own input.
2. near duplicates: of each class of documents linked at 5-word Jaccard 0.8 or
   more one stays.
3. personal data: validated values are replaced by format-preserving pseudonyms.
4. mixing: sources are repeated or sampled to their target weights; a document
   taken several times is as many rows.
5. packing: token pieces and their places in sequences of 4096 tokens.

Empty input passes every stage as an empty table with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsbeam.llm import chosen_path, common, mixing, packing, pseudonyms, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    cols = docs.columns
    return toxicity.grade(toxicity.score(docs, model), model).where("NOT rejected").select(*cols)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return chosen_path.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return pseudonyms.pseudonymise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return mixing.repeat_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return packing.pack_pieces(common.stage(packing.tokenize(docs), "pieces"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("personal_data", hide_personal_data),
          ("mixing", mix_sources), ("packing", pack)]

#: the first stage is a fitted model and the last a search: not SQL; tests/llm holds run() against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = common.stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
