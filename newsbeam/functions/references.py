"""HTML character references decoded natively, all of them (EXT-2).

One regular expression cuts a text into references and what lies between; numeric references
are decoded by arithmetic with HTML's replacement rules, named ones by a map literal made of
the standard library's table.  A name without its semicolon is matched by the longest
beginning that HTML knows without one (``&notit;`` is ``¬it;``), as ``html.unescape`` does, and
what is no reference stays as it is.  Everything is a Spark expression, so element text stays
inside the JVM; a text without ``&`` is passed through.
"""

from __future__ import annotations

import html
import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_BARE = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))  # known without a semicolon
_LONGEST_BARE = "^&(" + "|".join(_BARE) + ")"


def _named() -> Column:
    names = sorted(html.entities.html5)
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.lit(html.entities.html5[n]) for n in names]))


def _numbers() -> Column:
    """Numbers that do not stand for their own character: 0, and 128 to 159 (Windows-1252 where it has one)."""
    pairs = {n: html.unescape(f"&#{n};") for n in (0, 13, *range(128, 160))}
    return F.map_from_arrays(F.array(*[F.lit(n).cast("long") for n in pairs]), F.array(*[F.lit(c) for c in pairs.values()]))


def _dropped(n: Column) -> Column:
    """Numbers that give no text: control characters and noncharacters."""
    control = n.between(1, 8) | (n == 11) | n.between(14, 31) | n.between(127, 159)
    return control | n.between(0xFDD0, 0xFDEF) | ((n % 65536) >= 65534)


def _utf8(n: Column) -> Column:
    """The character of a code point up to U+10FFFF, by its UTF-8 bytes."""
    def byte(first: int, shift: int, mask: int) -> Column:
        return F.lpad(F.hex((F.lit(first) + F.shiftright(n, shift).bitwiseAND(F.lit(mask))).cast("long")), 2, "0")
    coded = (F.when(n < 0x80, byte(0, 0, 0x7F))
             .when(n < 0x800, F.concat(byte(0xC0, 6, 0x1F), byte(0x80, 0, 0x3F)))
             .when(n < 0x10000, F.concat(byte(0xE0, 12, 0x0F), byte(0x80, 6, 0x3F), byte(0x80, 0, 0x3F)))
             .otherwise(F.concat(byte(0xF0, 18, 0x07), byte(0x80, 12, 0x3F), byte(0x80, 6, 0x3F), byte(0x80, 0, 0x3F))))
    return F.decode(F.unhex(coded), "UTF-8")


def _number(ref: Column) -> Column:
    """The number of ``&#...`` (decimal or hexadecimal); a digit string too long for one counts as too large."""
    digits = F.regexp_extract(ref, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    base = F.when(ref.rlike("^&#[xX]"), F.lit(16)).otherwise(F.lit(10))
    value = F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits)
    return F.when(digits == "", F.lit(0).cast("long")).when(F.length(digits) > 9, F.lit(0x110000).cast("long")).otherwise(value.try_cast("long"))


def _numeric(ref: Column) -> Column:
    n = _number(ref)
    special = F.try_element_at(_numbers(), n)
    return (F.when(special.isNotNull(), special)
            .when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("�"))
            .when(_dropped(n), F.lit("")).otherwise(_utf8(n)))


def _name(ref: Column) -> Column:
    whole = F.try_element_at(_named(), F.substr(ref, F.lit(2)))
    bare = F.regexp_extract(ref, _LONGEST_BARE, 1)
    beginning = F.concat(F.try_element_at(_named(), bare), F.substr(ref, F.length(bare) + 2))
    return F.coalesce(whole, F.when(bare != "", beginning), ref)


def decode_references(c) -> Column:
    """``c`` with all character references replaced, each once (``&amp;lt;`` gives ``&lt;``)."""
    t = F.col(c) if isinstance(c, str) else c
    refs = F.regexp_extract_all(t, F.lit(f"({_REFERENCE})"), F.lit(1))
    between = F.split(t, _REFERENCE, -1)
    decoded = F.transform(refs, lambda r: F.when(r.startswith("&#"), _numeric(r)).otherwise(_name(r)))
    # one more piece than references: the last is followed by nothing
    joined = F.array_join(F.zip_with(between, F.concat(decoded, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    return F.when(t.contains("&"), joined).otherwise(t)
