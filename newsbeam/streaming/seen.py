"""STR-3 / STR-4 with state of its own: first copies out, late rows kept.

``dedupe_with_state`` keeps the headlines seen per day in operator state
(``transformWithStateInPandas``) and returns every first copy; a row that comes after its day
was closed is not dropped but marked ``late``, so first copies and late rows together hold
every distinct headline of the input.

State: a day's headlines are dealt to ``buckets`` by digest; the state of one (day, bucket) is
one value, the 16-byte digests seen so far, no text.  An event-time timer at the day's end plus
the delay removes it.  A late row finds no state of its day (or that of other late rows, kept
until the watermark has moved on by the delay, so their copies are not repeated at once).

Spark filters rows behind the watermark out of event-time operators that see the watermark
column; here the watermark is set on a copy of the event time that is not handed on, so the
operator gets all rows and the watermark still drives the timers.

Skew: each Arrow batch is reduced to its first row per headline before the shuffle, so a
headline that makes up a third of a landing reaches the state as one row per batch of rows.
The number of buckets sets how many digests one task holds at a time: a day's headlines
divided by ``buckets``.  The provider has to be RocksDB (``ROCKSDB_STATE``).
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.keys import digest
from ..operators.merge import KEY
from .cycle import EVENT_TIME

BUCKETS = 64
DIGEST = 16  # bytes
KEY_COL, BUCKET_COL = "key__", "bucket__"  # the stateful operator renames columns that begin with an underscore
_DAY_MS = 86_400_000


def _day_ms(day: dt.date) -> int:
    return (day - dt.date(1970, 1, 1)).days * _DAY_MS


class SeenHeadlines(StatefulProcessor):
    """Per (day, bucket): rows whose digest was not seen; ``late`` if the day was closed before."""

    def __init__(self, columns: list[str], delay_ms: int):
        self.columns = columns
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("digests", T.BinaryType())]))

    def handleInputRows(self, key, rows, timerValues):
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        frame = pd.concat(frames).sort_values(EVENT_TIME, kind="stable").drop_duplicates(KEY_COL)
        old = self.seen.get()[0] if self.seen.exists() else b""
        seen = np.frombuffer(bytes(old), f"S{DIGEST}")
        # numpy cuts trailing zeros of both sides alike
        own = np.array([bytes(k) for k in frame[KEY_COL]], f"S{DIGEST}")
        fresh = ~np.isin(own, seen)
        if not fresh.any():
            return
        raw = b"".join(bytes(k) for k in frame[KEY_COL][fresh])
        self.seen.update((bytes(old) + raw,))
        now = timerValues.getCurrentWatermarkInMs()
        closes = _day_ms(key[0]) + _DAY_MS + self.delay_ms if key[0] is not None else now + self.delay_ms
        late = closes <= now
        if not old:  # one timer per state: for a closed day counted from the watermark
            self.handle.registerTimer(now + self.delay_ms if late else closes)
        out = frame.loc[fresh, self.columns].copy()
        out["late"] = late
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def first_in_batch(stream: DataFrame) -> DataFrame:
    """Each Arrow batch reduced to its first row (by event time) of every ``KEY_COL``."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                order = pc.sort_indices(batch, sort_keys=[(EVENT_TIME, "ascending")])
                keys = batch.column(KEY_COL).take(order).to_pylist()
                at: dict = {}
                for i, k in zip(order.to_pylist(), keys):
                    at.setdefault(k, i)
                batch = batch.take(pa.array(sorted(at.values())))
            yield batch
    return stream.mapInArrow(run, stream.schema)


def dedupe_with_state(stream: DataFrame, delay: str = "1 day", delay_ms: int = _DAY_MS, buckets: int = BUCKETS, keys=KEY) -> DataFrame:
    """First copies of ``stream(day, symbol, headline, event_time, ...)`` and late rows, with the
    boolean column ``late``; ``delay`` and ``delay_ms`` say the same.  ``keys``: what equal headlines have equal,
    the day among it."""
    key = F.substring(digest(*keys), 1, DIGEST)
    columns = list(stream.columns)
    keyed = stream.withColumn(KEY_COL, key).withColumn("wm__", F.col(EVENT_TIME)).withWatermark("wm__", delay).drop("wm__")
    reduced = first_in_batch(keyed).withColumn(BUCKET_COL, F.pmod(F.xxhash64(KEY_COL), F.lit(buckets)))
    schema = T.StructType([*stream.schema.fields, T.StructField("late", T.BooleanType())])
    return reduced.groupBy("day", BUCKET_COL).transformWithStateInPandas(
        statefulProcessor=SeenHeadlines(columns, delay_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime")


def split_writer(first_path: str, late_path: str):
    """``foreachBatch`` sink: first copies and late rows to tables of their own, per ``batch_id``."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()
        try:
            for late, path in ((False, first_path), (True, late_path)):
                (batch_df.where(F.col("late") == F.lit(late)).drop("late").withColumn("batch_id", F.lit(batch_id).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
        finally:
            batch_df.unpersist()
    return write
