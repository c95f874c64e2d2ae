"""Extraction: native element patterns and the general CSS path."""

import pytest
from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.operators.extract import parse_selector, select_texts

PAGE = """<html><head><title>T</title><script>var t="</p>";</script><link rel="x"></head><body>
<nav><ul><li><a href="/a">One &amp; two</a></li><li><a href="/b">
  Three</a></li></ul></nav>
<div class="ad big">Buy <b>now</b> &copy;</div>
<div class="news_title x"><h5 class="base-text t1">Head 1</h5></div>
<div class="news_title"><h5 class="base-text">not matched</h5></div>
<div class="news_title x"><span><h5 class="base-text t1">Head 2</h5></span></div>
<article><h1>Title &quot;q&quot;</h1><p>p1<p>p2</p></article>
</body></html>"""


def sel(*pairs):
    return [(n, parse_selector(s)) for n, s in pairs]


def test_parse_selector():
    assert parse_selector("div.a.b h5.c") == [("div", frozenset({"a", "b"})), ("h5", frozenset({"c"}))]
    assert parse_selector(".x") == [(None, frozenset({"x"}))]


def test_descendant_and_classes():
    out = select_texts(PAGE, sel(("h", "div.news_title.x h5.base-text.t1")))
    assert out == [("h", "Head 1"), ("h", "Head 2")]


def test_text_decodes_and_strips():
    out = select_texts(PAGE, sel(("a", "nav li a"), ("ad", "div.ad"), ("t", "h1")))
    assert out == [("a", "One & two"), ("a", "Three"), ("ad", "Buy now ©"), ("t", 'Title "q"')]


def test_script_text_is_raw():
    assert select_texts(PAGE, sel(("p", "p"))) == [("p", "p1p2"), ("p", "p2")]


def test_extract_css_frame(spark):
    pages = spark.createDataFrame([(1, "http://h.example/x", PAGE), (2, "http://g.example/", None)],
                                  "page_id long, url string, html string")
    rows = op.extract_css(pages, {"a": "nav li a"}).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.selector, r.pos, r.text) for r in rows] == [(1, "a", 0, "One & two"), (1, "a", 1, "Three")]


def test_native_matches_general_on_pages(spark):
    """The regex path and the parser path agree on the driver pages."""
    from tests.conftest import SF01
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    native = pages.select("page_id", F.posexplode(op.element_texts("html", "div", ("ad",))).alias("pos", "text"))
    general = op.extract_css(pages, {"ad": "div.ad"}).select("page_id", "pos", "text")
    assert native.exceptAll(general).count() == 0 and general.exceptAll(native).count() == 0
    assert native.count() == 250


@pytest.mark.parametrize("tag,classes,html,expected", [
    ("li", (), "<link href='x'><li>a</li><li class='k'>b</li>", ["a", "b"]),
    ("a", (), "<article><a href='/x'>in</a></article><abbr>no</abbr>", ["in"]),
    ("div", ("ad",), '<div class="x ad y">1</div><div class="adx">2</div><div class="ad">3\n4</div>', ["1", "3\n4"]),
])
def test_element_pattern(spark, tag, classes, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(op.element_texts("html", tag, classes).alias("x")).first().x == expected


def test_extract_headlines_general_pairs_by_position(spark):
    pages = spark.createDataFrame([(1, "http://h.example/x", PAGE)], "page_id long, url string, html string")
    rows = op.extract_headlines(pages, "nav li a", "div.ad", feed="A").orderBy("pos").collect()
    assert [(r.symbol, r.pos, r.headline, r.date_text) for r in rows] == [
        ("h.example", 0, "One & two", "Buy now ©"), ("h.example", 1, "Three", None)]


def test_extract_headlines_native(spark):
    pages = spark.createDataFrame([(1, "http://h.example/x", PAGE)], "page_id long, url string, html string")
    rows = op.extract_headlines(pages, "h5.base-text.t1", "div.ad").orderBy("pos").collect()
    assert [(r.pos, r.headline, r.date_text) for r in rows] == [(0, "Head 1", "Buy now ©"), (1, "Head 2", None)]


def test_pandas_scorer_matches_native_on_records(spark):
    from newsbeam.sources.fixtures import headline_records, headlines_view
    from tests.conftest import SF01
    recs = headline_records(headlines_view(spark, SF01))
    a = op.label_headlines(recs, op.PandasScorer(op.lexicon_model()))
    b = op.label_headlines(recs, op.LexiconScorer())
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pandas_scorer_with_even_spread(spark):
    from newsbeam.sources.fixtures import headline_records, headlines_view
    from tests.conftest import SF01
    recs = headline_records(headlines_view(spark, SF01))
    a = op.label_headlines(recs, op.PandasScorer(op.lexicon_model(), partitions=5))
    b = op.label_headlines(recs, op.LexiconScorer())
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


MIXED = """<DIV class='ad x'>one</DIV><div class=ad>two</div><div CLASS="AD">no</div>
<div class="adx">no</div><ul><li><A HREF='/a'>A</A></li><li><a href=/b>B</a></li><li><a href="">C</a></li></ul>"""


def test_native_quotes_and_case_match_general(spark):
    df = spark.createDataFrame([(1, MIXED)], "page_id long, html string")
    native = df.select(op.element_texts("html", "div", ("ad",)).alias("x"),
                       op.attr_values("html", "href").alias("h")).first()
    general = [t for _, t in select_texts(MIXED, sel(("ad", "div.ad")))]
    assert native.x == general == ["one", "two"]
    assert native.h == ["/a", "/b", ""]


def test_prepared_recorded_scorer(spark):
    from newsbeam.sources.fixtures import headline_records, headlines_view, recorded_answers
    from tests.conftest import SF01
    recs = headline_records(headlines_view(spark, SF01))
    plain = op.label_headlines(recs, op.RecordedScorer(recorded_answers(spark, SF01)))
    ready = op.label_headlines(recs, op.RecordedScorer(recorded_answers(spark, SF01)).prepared(4))
    assert ready.exceptAll(plain).count() == 0 and plain.exceptAll(ready).count() == 0
