"""Scans: driver tables, landed pages, seed lists, prompt files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale-factor folder (scan is lazy; Catalyst prunes)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: landed pages ``(page_id, url, html)``; ``path`` is a file or an sf folder."""
    if os.path.isdir(path) and os.path.exists(os.path.join(path, "pages.parquet")):
        path = os.path.join(path, "pages.parquet")
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_day(headlines: DataFrame, day) -> DataFrame:
    """SRC-2: one day's headlines.  On a table partitioned by ``day`` the
    predicate becomes a partition filter, so only that folder is listed."""
    return headlines.where(F.col("day") == F.lit(day).cast("date"))


def symbols_df(spark: SparkSession, symbols: list[str]) -> DataFrame:
    """SRC-3: the seed list in key order ``(ord, symbol)``."""
    return spark.createDataFrame(list(enumerate(symbols)), "ord int, symbol string")


def symbol_dim_df(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """SRC-4: ticker -> slug dimension ``(symbol, slug)``."""
    return spark.createDataFrame(sorted(mapping.items()), "symbol string, slug string")


def read_prompts(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """SRC-5: a fixed prompt set ``(prompt)``.

    ``text``: one prompt per file (prompts span lines, so files are read whole).
    ``parquet``: a table with a ``prompt`` column.
    """
    if fmt == "text":
        return spark.read.text(path, wholetext=True).select(F.col("value").alias("prompt"))
    if fmt == "parquet":
        return spark.read.parquet(path).select(F.col("prompt").cast(T.StringType()))
    raise ValueError(f"unknown prompt format {fmt!r}")
