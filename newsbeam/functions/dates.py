"""Day keys and timestamps.

All stages take one ``as_of`` timestamp instead of reading the clock, so a
run has one day key and one ``created`` value however long it takes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of the day key ("Aug 05, 2023") and of the
# snapshot time ("2023-08-05 14:03:59").
DAY_KEY_FORMAT = "MMM dd, yyyy"
SNAPSHOT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of: dt.datetime | str) -> Column:
    """The run's ``now`` as a timestamp literal."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    return F.lit(as_of).cast("timestamp")


def day_of(c) -> Column:
    return F.to_date(_col(c))


def day_key_text(c) -> Column:
    """Render a date or timestamp as the day key text."""
    return F.date_format(_col(c), DAY_KEY_FORMAT)


def snapshot_time_text(c) -> Column:
    return F.date_format(_col(c), SNAPSHOT_TIME_FORMAT)


def parse_day_text(c) -> Column:
    """Day key text to a date; null when it is not in the exact form."""
    return F.try_to_timestamp(_col(c), F.lit(DAY_KEY_FORMAT)).cast("date")
