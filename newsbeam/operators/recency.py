"""Recency and same-day filters (stateless, native predicates).

Modes of ``is_recent``:

* ``strict30`` (production feed A): exactly ``an hour ago`` passes; text
  holding ``minutes`` passes when its first word is a number <= 30; all else
  fails (so 31..59 minutes fail while an hour passes).
* ``lenient`` (older feed A): exactly ``an hour ago``, or any text holding
  ``minutes``.
* ``within`` with ``minutes=n``: the age parsed to minutes is <= n (the one
  hour window the run notes describe, with ``minutes=60``).

A ``minutes`` text whose first word is not a number cannot be judged; it is
not recent and ``classify_age`` marks it ``quarantine`` instead of failing
the whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_key_text, parse_day_text
from ..functions.text import first_word_int

# The age texts feed A prints.
AN_HOUR_AGO = "an hour ago"
MINUTES = "minutes"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_minutes(c) -> Column:
    """Relative age text to whole minutes; null when unreadable."""
    t = _col(c)
    n = first_word_int(t)
    return (F.when(t == "a few seconds ago", F.lit(0))
            .when(t == "a minute ago", F.lit(1))
            .when(t == AN_HOUR_AGO, F.lit(60))
            .when(t.endswith(" minutes ago"), n)
            .when(t.endswith(" hours ago"), n * 60))


def is_recent(c, mode: str = "strict30", minutes: int = 30) -> Column:
    t = _col(c)
    hour = t == AN_HOUR_AGO
    has_minutes = t.contains(MINUTES)
    if mode == "strict30":
        ok = hour | (has_minutes & (first_word_int(t) <= F.lit(30)))
    elif mode == "lenient":
        ok = hour | has_minutes
    elif mode == "within":
        ok = age_minutes(t) <= F.lit(minutes)
    else:
        raise ValueError(f"unknown recency mode {mode!r}")
    return F.coalesce(ok, F.lit(False))


def unreadable_age(c, mode: str = "strict30") -> Column:
    """True when the mode needs a number that the text does not hold."""
    t = _col(c)
    if mode == "lenient":
        return F.lit(False)
    if mode == "strict30":
        return F.coalesce(t.contains(MINUTES) & (t != AN_HOUR_AGO) & first_word_int(t).isNull(),
                          F.lit(False))
    return F.coalesce(age_minutes(t).isNull(), F.lit(True))


def classify_age(df: DataFrame, col: str = "date_text", mode: str = "strict30",
                 minutes: int = 30, out: str = "outcome") -> DataFrame:
    """One pass: ``pass`` / ``fail`` / ``quarantine`` per row."""
    return df.withColumn(
        out,
        F.when(unreadable_age(col, mode), F.lit("quarantine"))
        .when(is_recent(col, mode, minutes), F.lit("pass"))
        .otherwise(F.lit("fail")))


def split_recent(df: DataFrame, col: str = "date_text", mode: str = "strict30",
                 minutes: int = 30) -> tuple[DataFrame, DataFrame]:
    """(recent rows, quarantine rows with a ``reason``)."""
    kept = df.where(is_recent(col, mode, minutes))
    bad = df.where(unreadable_age(col, mode)).withColumn("reason", F.lit("unreadable_age"))
    return kept, bad


def is_same_day(c, day, mode: str = "date") -> Column:
    """FLT-3: the item's date text names ``day``.

    ``date``: parse the text in the day-key form and compare dates.
    ``text``: compare with the rendered day key character by character.
    Both reject ``Aug 5, 2023`` for ``Aug 05, 2023``.
    """
    d = F.lit(day).cast("date")
    if mode == "date":
        return F.coalesce(parse_day_text(c) == d, F.lit(False))
    if mode == "text":
        return F.coalesce(_col(c) == day_key_text(d), F.lit(False))
    raise ValueError(f"unknown same-day mode {mode!r}")


def nonempty_symbols(items: DataFrame, universe: DataFrame, keys=("symbol",)) -> DataFrame:
    """FLT-4: symbols of ``universe`` that have at least one item (semi join; null equals null).
    Item keys are de-duplicated first (partial aggregate), so a symbol with
    many items is one row on the build side."""
    known = items.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return universe.join(known, same, "left_semi")
