"""Seed URLs and the ticker -> slug lookup.

The join to the symbol dimension is left to the planner: a dimension read
from a table is broadcast when its file statistics are under
``spark.sql.autoBroadcastJoinThreshold`` (or at run time by adaptive
execution once its real size is known); a larger one falls back to a
shuffle join.  No broadcast hint is set on data whose size is not known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The URL shapes of the two feeds' symbol pages.  The hosts are
# parameters (``base``); the defaults are placeholders.
FEED_A_BASE = "https://feed-a.example/currencies/"
FEED_B_BASE = "https://feed-b.example/search"
STYLES = ("slug", "slug_news", "search")


def lookup_slug(symbols: DataFrame, dim: DataFrame) -> DataFrame:
    """JN-1: symbols with their slug; unknown symbols drop out (see ``unknown_symbols``)."""
    return symbols.join(dim, "symbol", "inner")


def unknown_symbols(symbols: DataFrame, dim: DataFrame) -> DataFrame:
    """Symbols missing from the dimension, as quarantine rows."""
    return (symbols.join(dim.select("symbol").distinct(), "symbol", "left_anti")
            .withColumn("reason", F.lit("unknown_symbol")))


def seed_urls(symbols: DataFrame, dim: DataFrame | None = None, style: str = "slug",
              base: str | None = None) -> DataFrame:
    """PRJ-1..3: one URL per symbol.

    ``slug``: ``base + slug``; ``slug_news``: ``base + slug + '/news'``;
    ``search``: ``base + '?s=' + symbol + '&sort=1'`` (no dimension needed).
    """
    if style == "search":
        b = base or FEED_B_BASE
        return symbols.withColumn("url", F.concat(F.lit(b + "?s="), F.col("symbol"), F.lit("&sort=1")))
    if dim is None:
        raise ValueError(f"style {style!r} needs the symbol dimension")
    b = base or FEED_A_BASE
    joined = lookup_slug(symbols, dim)
    if style == "slug":
        url = F.concat(F.lit(b), F.col("slug"))
    elif style == "slug_news":
        url = F.concat(F.lit(b), F.col("slug"), F.lit("/news"))
    else:
        raise ValueError(f"unknown url style {style!r}")
    return joined.withColumn("url", url)
