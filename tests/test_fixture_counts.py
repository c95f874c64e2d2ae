"""Counts of the fixture view H at sf0.01 and sf0.1, as listed in FIXTURES.md."""

import pytest

import __spark_entry__ as E

EXPECTED = {
    "/root/testdata/sf0.01": {"recent_strict30": 615, "recent_lenient": 802, "same_day": 339,
                              "novel_headlines": 1513, "merge_day": 6513, "combine_feeds": 3356},
    "/root/testdata/sf0.1": {"recent_strict30": 6203, "recent_lenient": 8192, "same_day": 3244,
                             "novel_headlines": 14993, "merge_day": 64993, "combine_feeds": 33311},
}


@pytest.mark.parametrize("sf_dir", sorted(EXPECTED))
def test_counts(spark, sf_dir):
    q = E.queries()
    got = {k: q[k](spark, sf_dir).count() for k in EXPECTED[sf_dir]}
    assert got == EXPECTED[sf_dir]


def test_view_shape_sf01(spark):
    from newsbeam.sources.fixtures import headlines_view
    h = headlines_view(spark, "/root/testdata/sf0.1", ages=True)
    row = h.selectExpr("count(*) AS n", "count(DISTINCT symbol) AS s", "count(DISTINCT day) AS d",
                       "sum(CASE WHEN feed = 'A' THEN 1 ELSE 0 END) AS a").first()
    assert (row.n, row.s, row.d, row.a) == (100000, 20, 30, 50000)


def test_every_event_and_every_text_is_read(spark):
    from newsbeam.functions.text import strip_ws
    from newsbeam.sources.fixtures import headlines_view
    sf = "/root/testdata/sf0.01"
    h = headlines_view(spark, sf)
    events = spark.read.parquet(f"{sf}/events.parquet")
    assert events.join(h, events.event_id == h.doc_id, "left_anti").count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(strip_ws("text").alias("headline"))
    assert docs.join(h.select("headline"), "headline", "left_anti").count() == 0
