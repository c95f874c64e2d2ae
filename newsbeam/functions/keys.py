"""Digests as keys: one non-null 32-byte value in place of long texts and nullable columns.

SHA-256 has no known two inputs of equal digest, so rows of equal digest are taken as equal
without comparing their texts.  Null differs from every text, the empty one included, and
equals null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADLINE_KEY = "headline_key"  # the digest of a headline, in rows that hold it in place of the text


def headline_col(df: DataFrame) -> str:
    """The column that stands for the headline: ``headline_key`` in keyed rows, else ``headline``."""
    return HEADLINE_KEY if HEADLINE_KEY in df.columns and "headline" not in df.columns else "headline"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _marked(c) -> Column:
    """A value as text that no other value's text and none of its beginnings equals: its length, then itself."""
    t = _col(c).cast("string")
    return F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))


def digest(*cols) -> Column:
    """The 32-byte digest of one or more columns."""
    return F.unhex(F.sha2(F.concat(*[_marked(c) for c in cols]).cast("binary"), 256))
