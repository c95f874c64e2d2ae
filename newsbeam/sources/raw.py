"""Raw landed pages: files of HTML, one page each, decoded by their own charset (SRC-1)."""

from __future__ import annotations

import codecs
import re
from typing import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import arrow_batches, make_dir

#: the columns of the binary file source, then the folders ``feed=.../symbol=...``
FILES = "path string, modificationTime timestamp, length bigint, content binary, feed string, symbol string"
META = r"""(?is)<meta[^>]*?charset\s*=\s*["']?\s*([a-z0-9_:.-]+)"""
HEAD = 1024  # bytes that may hold the meta tag, as browsers read it
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a value, as Spark's sinks name it
LANDING_BATCH = (1024, "4m")  # records and bytes of an Arrow batch of pages
# labels that browsers read as windows-1252 (fixed values)
WESTERN = ("windows-1252", "cp1252", "iso-8859-1", "latin1", "latin-1", "us-ascii", "ascii")
# bytes 80 to 9f: control characters in ISO 8859-1, letters and signs in windows-1252; five stay as they are
_C1 = {chr(b): bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}


@F.pandas_udf(T.StringType())
def _decode_other(content: pd.Series, charset: pd.Series) -> pd.Series:
    def one(raw, name):
        if raw is None:
            return None
        try:
            codecs.lookup(name)
            return raw.decode(name, "replace")
        except (LookupError, ValueError):  # an unknown label, or a codec that is not for text
            return raw.decode("utf-8", "replace")
    return pd.Series([one(c, n) for c, n in zip(content, charset, strict=True)], dtype=object)


def charset_of(content: Column) -> Column:
    """Charset of a page's bytes: its byte order mark, else its meta tag, else UTF-8."""
    mark = F.hex(F.substring(content, 1, 3))
    named = F.lower(F.regexp_extract(F.decode(F.substring(content, 1, HEAD), "ISO-8859-1"), META, 1))
    wide = named.startswith("utf-16") | named.startswith("utf-32")  # a tag that reads as ASCII is in no such text
    return (F.when(mark == "EFBBBF", F.lit("utf-8")).when(mark.startswith("FFFE"), F.lit("utf-16-le")).when(mark.startswith("FEFF"), F.lit("utf-16-be"))
            .when((named == "") | (named == "utf8") | wide, F.lit("utf-8")).when(named.isin(*WESTERN), F.lit("windows-1252")).otherwise(named))


def decode_pages(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` with ``html`` and ``charset`` in place of ``content``.  UTF-8 and the western charsets are
    decoded in the JVM; only pages in another one are handed to Python.  Bytes that a charset
    does not have become U+FFFD, a byte order mark goes, null stays null."""
    rest = [c for c in files.columns if c != content]
    raw = files.select(*rest, F.col(content).alias("__raw"), charset_of(F.col(content)).alias("charset"))
    native = F.col("charset").isin("utf-8", "windows-1252")
    western = F.translate(F.decode("__raw", "ISO-8859-1"), "".join(_C1), "".join(_C1.values()))
    html = (F.when(F.col("charset") == "utf-8", F.make_valid_utf8(F.col("__raw").cast("string"))).when(F.col("charset") == "windows-1252", western)
            .otherwise(_decode_other(F.when(~native, F.col("__raw")), "charset")))
    return raw.select(*rest, F.regexp_replace(html, "^﻿", "").alias("html"), "charset")


def read_raw_pages(spark: SparkSession, path: str, pattern: str = "*.html", stream: bool = False, extra: str = "") -> DataFrame:
    """Pages landed as files under ``path/feed=.../symbol=.../``: ``(symbol, feed, url, html, landed_at, charset)``,
    with the file's path as url and its time as landed_at; an empty file gives no row.  ``stream``: new files as a stream, remembered
    by its checkpoint.  ``extra``: further folder levels below symbol, as a schema; their columns come last."""
    reader = (spark.readStream if stream else spark.read).format("binaryFile").option("pathGlobFilter", pattern)
    files = reader.schema(FILES + (f", {extra}" if extra else "")).load(path)
    more = files.columns[6:]
    pages = decode_pages(files.drop("length"))
    return pages.select("symbol", "feed", F.col("path").alias("url"), "html", F.col("modificationTime").alias("landed_at"), "charset", *more)


def _folder(name: str, value) -> str:
    """``name=value``; characters that a path may not hold are written as Spark's sinks write them."""
    plain = re.sub(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE
    return f"{name}={plain}"


def land_pages(pages: DataFrame, path: str) -> None:
    """Pages ``(feed, symbol, page_id, raw)`` as files ``path/feed=.../symbol=.../<page_id>-<task>.txt``: the bytes and
    a line feed; rows of one task that agree in the first three share a file, each behind the other.

    The tasks write through Arrow's file systems, to any store that Arrow opens: Hadoop's local one starts ``chmod`` for
    every file it creates, and a folder per page is made, moved and listed besides.  A file is moved to its name when it is whole,
    and a repeated task has the same names."""
    spark = pages.sparkSession
    uri = re.sub("^file:/+", "/", make_dir(spark, path))

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext
        store, root = fs.FileSystem.from_uri(uri)
        task = TaskContext.get()
        part, files, made, key, out, name = task.partitionId(), 0, None, None, None, None

        def close():
            out.close()
            store.move(f"{name[0]}/.{name[1]}.{task.taskAttemptId()}", "/".join(name))
        for batch in batches:
            for *row, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or row != key:
                    if out is not None:
                        close()
                    folder = f"{root}/{_folder('feed', row[0])}/{_folder('symbol', row[1])}"
                    if folder != made:
                        store.create_dir(folder, recursive=True)
                    key, made, files = row, folder, files + 1
                    name = folder, f"{'null' if row[2] is None else row[2]}-{part:05d}.txt"
                    out = store.open_output_stream(f"{name[0]}/.{name[1]}.{task.taskAttemptId()}")
                out.write((raw or b"") + b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})
    rows = pages.select(F.coalesce("feed", F.lit("")).alias("feed"), F.coalesce("symbol", F.lit("")).alias("symbol"), F.col("page_id").cast("long"), "raw")
    with arrow_batches(spark, *LANDING_BATCH):
        # one row per task is summed; the sort spills
        rows.sortWithinPartitions("feed", "symbol", "page_id").mapInArrow(land, "files long").agg(F.sum("files")).first()
