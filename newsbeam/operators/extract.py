"""Headline extraction from landed pages.

Native path (``element_html`` / ``extract_items``): for a fixed tag with
optional classes and no nesting of the same tag, ``regexp_extract_all`` in
dot-all mode finds the elements inside the JVM, in document order.

General path (``extract_css``): CSS selectors made of compounds
``tag.class1.class2`` joined by the descendant combinator, evaluated by a
small stack matcher over Python's streaming HTML tokenizer inside
``mapInPandas`` (one pass per page, Arrow batches, no per-row UDF calls).
It follows the tree rules of a plain parser: void elements never open, an
end tag closes up to the nearest open element of that name, script/style
text is raw.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import element_text, host_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


# --------------------------------------------------------------------------- native


def _class_look(c: str) -> str:
    """Lookahead: the start tag's class attribute (double, single or no
    quotes) holds the class ``c`` as a whole word."""
    c = re.escape(c)
    return (rf"""(?=[^>]*\s(?i:class)\s*=\s*(?:"(?:[^"]*\s)?{c}(?:\s[^"]*)?"|'(?:[^']*\s)?{c}(?:\s[^']*)?'"""
            rf"""|{c}(?=[\s>/])))""")


def element_pattern(tag: str, classes: tuple[str, ...] = ()) -> str:
    """Regex whose group 1 is the inner markup of ``<tag class="...">``."""
    t = re.escape(tag)
    looks = "".join(_class_look(c) for c in classes)
    return rf"(?s)<(?i:{t}){looks}(?:\s[^>]*)?>(.*?)</(?i:{t})\s*>"


def element_html(html, tag: str, classes: tuple[str, ...] = ()) -> F.Column:
    """EXT-1 native: inner markup of every matching element, in order."""
    col = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract_all(col, F.lit(element_pattern(tag, classes)), F.lit(1))


def attr_values(html, attr: str) -> F.Column:
    """Every value of ``attr`` (double, single or no quotes) in document order."""
    col = F.col(html) if isinstance(html, str) else html
    a = re.escape(attr)
    pat = rf"""(?s)\s(?i:{a})\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.transform(
        F.regexp_extract_all(col, F.lit(rf"""(?s)\s(?i:{a})\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(0)),
        lambda m: F.coalesce(F.nullif(F.regexp_extract(m, pat, 1), F.lit("")),
                             F.nullif(F.regexp_extract(m, pat, 2), F.lit("")),
                             F.regexp_extract(m, pat, 3)))


def element_texts(html, tag: str, classes: tuple[str, ...] = ()) -> F.Column:
    """EXT-1 + EXT-2: stripped text of every matching element."""
    return F.transform(element_html(html, tag, classes), lambda x: element_text(x))


def zip_items(headlines, dates) -> F.Column:
    """EXT-3: pair by position; extra dates are ignored, a missing date is null."""
    h = F.col(headlines) if isinstance(headlines, str) else headlines
    d = F.col(dates) if isinstance(dates, str) else dates
    pairs = F.zip_with(h, d, lambda x, y: F.struct(y.alias("date_text"), x.alias("headline")))
    return F.slice(pairs, 1, F.size(h))


def extract_items(pages: DataFrame, headlines, dates, symbol=None, feed: str | None = None) -> DataFrame:
    """EXT-4: one row per item of every page ``(symbol, feed, pos, date_text, headline)``.

    ``headlines`` / ``dates`` are array columns (e.g. ``element_texts``).
    Pages without items produce no rows (inner explode).
    """
    sym = host_of("url") if symbol is None else (F.col(symbol) if isinstance(symbol, str) else symbol)
    keep = [c for c in ("page_id",) if c in pages.columns]
    return (pages.select(*keep, sym.alias("symbol"), F.lit(feed).cast("string").alias("feed"),
                         F.posexplode(zip_items(headlines, dates)).alias("pos", "item"))
            .select(*keep, "symbol", "feed", F.col("pos").cast("long").alias("pos"),
                    "item.date_text", "item.headline"))


def unpaired_items(items: DataFrame) -> DataFrame:
    """E5: items without a date go to quarantine."""
    return items.where(F.col("date_text").isNull()).withColumn("reason", F.lit("missing_date"))


# --------------------------------------------------------------------------- general CSS


def parse_selector(sel: str) -> list[tuple[str | None, frozenset]]:
    """``'div.a.b h5.c'`` -> [('div', {'a','b'}), ('h5', {'c'})]."""
    steps = []
    for part in sel.split():
        bits = part.split(".")
        tag = bits[0].lower() or None
        if tag == "*":
            tag = None
        steps.append((tag, frozenset(b for b in bits[1:] if b)))
    if not steps:
        raise ValueError("empty selector")
    return steps


def _matches(step, tag, classes) -> bool:
    t, cls = step
    return (t is None or t == tag) and cls <= classes


class _Collector(HTMLParser):
    def __init__(self, selectors: list[tuple[str, list]]):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.stack: list[tuple[str, frozenset, list[int]]] = []
        self.found: list[tuple[str, list[str]]] = []
        self.active: dict[int, list[str]] = {}

    def _ancestors_match(self, steps) -> bool:
        i = len(steps) - 1
        for tag, classes, _ in reversed(self.stack):
            if i < 0:
                break
            if _matches(steps[i], tag, classes):
                i -= 1
        return i < 0

    def handle_starttag(self, tag, attrs):
        classes = frozenset(" ".join(v or "" for k, v in attrs if k == "class").split())
        opened = []
        for name, steps in self.selectors:
            if _matches(steps[-1], tag, classes) and self._ancestors_match(steps[:-1]):
                idx = len(self.found)
                self.found.append((name, []))
                opened.append(idx)
        if tag in VOID:
            return
        for idx in opened:
            self.active[idx] = self.found[idx][1]
        self.stack.append((tag, classes, opened))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1][0] == tag:
            self._pop_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop_to(i)
                return

    def _pop_to(self, i):
        for _, _, opened in self.stack[i:]:
            for idx in opened:
                self.active.pop(idx, None)
        del self.stack[i:]

    def handle_data(self, data):
        for buf in self.active.values():
            buf.append(data)


def select_texts(html: str | None, selectors: list[tuple[str, list]]) -> list[tuple[str, str]]:
    """(selector name, stripped text) of every match, in document order."""
    if html is None:
        return []
    p = _Collector(selectors)
    p.feed(html)
    p.close()
    return [(name, "".join(parts).strip()) for name, parts in p.found]


def extract_css(pages: DataFrame, selectors: dict[str, str], id_col: str = "page_id",
                html_col: str = "html", keep=()) -> DataFrame:
    """EXT-1 general: ``(id, *keep, selector, pos, text)`` for every element
    matching a selector; ``pos`` counts matches of one selector inside one
    page from 0.  ``keep`` columns pass through unchanged.
    """
    parsed = [(name, parse_selector(sel)) for name, sel in selectors.items()]
    keep = list(keep)
    src = pages.select(id_col, *keep, html_col)
    schema = T.StructType([src.schema[id_col], *[src.schema[c] for c in keep],
                           T.StructField("selector", T.StringType()),
                           T.StructField("pos", T.LongType()), T.StructField("text", T.StringType())])

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                seen: dict[str, int] = {}
                for name, text in select_texts(getattr(rec, html_col), parsed):
                    n = seen.get(name, 0)
                    seen[name] = n + 1
                    rows.append((getattr(rec, id_col), *[getattr(rec, c) for c in keep], name, n, text))
            out = pd.DataFrame(rows, columns=[id_col, *keep, "selector", "pos", "text"])
            yield out.astype({"pos": "int64"})

    return src.mapInPandas(run, schema)


def extract_headlines(pages: DataFrame, headline_css: str, date_css: str, symbol=None,
                      feed: str | None = None, id_col: str = "page_id") -> DataFrame:
    """EXT-4: items of every page from two CSS selectors, paired by position.

    Every selector is matched page by page in one pass that also pairs the two
    lists, so two landings of one page never mix and nothing shuffles, and the
    answer does not depend on the selector's shape (``extract_items`` is the
    native form for markup known to be plain).  Extra dates are ignored, a
    missing date is null (E5), pages without headlines produce no rows.
    """
    sym = host_of("url") if symbol is None else (F.col(symbol) if isinstance(symbol, str) else symbol)
    keyed = pages.select(id_col, sym.alias("symbol"), "html")
    parsed = [("h", parse_selector(headline_css)), ("d", parse_selector(date_css))]

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                texts: dict[str, list] = {"h": [], "d": []}
                for name, text in select_texts(rec.html, parsed):
                    texts[name].append(text)
                rows += [(getattr(rec, id_col), rec.symbol, n, texts["d"][n] if n < len(texts["d"]) else None, h)
                         for n, h in enumerate(texts["h"])]
            yield pd.DataFrame(rows, columns=[id_col, "symbol", "pos", "date_text", "headline"]).astype({"pos": "int64"})
    found = keyed.mapInPandas(run, T.StructType([keyed.schema[id_col], T.StructField("symbol", T.StringType()), T.StructField("pos", T.LongType()),
                                                 T.StructField("date_text", T.StringType()), T.StructField("headline", T.StringType())]))
    return found.select(id_col, "symbol", F.lit(feed).cast("string").alias("feed"), "pos", "date_text", "headline")
