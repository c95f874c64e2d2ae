"""String scalars, all native Spark expressions (stay inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() / str.split() treat as
# white space (str.isspace), as a regex class that both Java regex and RE2
# accept, and as the plain character set.
WS_CLASS = (r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")

# The HTML entities that the driver's pages hold, for the oracle's SQL;
# "&amp;" must be last so that "&amp;quot;" becomes "&quot;" and not a quote.
ENTITIES = [
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]

TAG_RE = r"<[^>]*>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing white space
    (``btrim`` with the character set: plain string code, no regex)."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def first_line(c) -> Column:
    """Text before the first newline (whole text when there is none)."""
    return F.substring_index(_col(c), "\n", 1)


def remove_tags(c) -> Column:
    return F.regexp_replace(_col(c), TAG_RE, "")


def decode_entities(c) -> Column:
    """All character references of HTML (``functions.references``)."""
    from .references import decode_references
    return decode_references(c)


def element_text(c) -> Column:
    """Text of an element's inner markup: tags removed, entities decoded, stripped."""
    return strip_ws(decode_entities(remove_tags(c)))


def first_word(c) -> Column:
    """First white-space separated word (Python ``x.split()[0]``); null if none."""
    parts = F.split(strip_ws(c), f"{WS_CLASS}+", 2)
    return F.when(strip_ws(c) != "", parts.getItem(0))


def first_word_int(c) -> Column:
    """First word as int, null when it is not a number (no exception under ANSI)."""
    return first_word(c).try_cast("int")


def contains(c, s: str) -> Column:
    return _col(c).contains(s)


def host_of(url) -> Column:
    """Host part of a URL (``parse_url(url, 'HOST')``)."""
    return F.try_parse_url(_col(url), F.lit("HOST"))
