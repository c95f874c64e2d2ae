"""Contract rows of the semantics table (E1..E22) on literal inputs."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsbeam import operators as op
from newsbeam.functions.answers import parse_answer, to_label
from newsbeam.functions.text import strip_ws
from newsbeam.operators.recency import classify_age, is_recent, is_same_day

AGES = ["an hour ago", "5 minutes ago", "30 minutes ago", "31 minutes ago", "a minute ago",
        "an hour ago today", "2 hours ago"]
AS_OF = dt.datetime(2023, 8, 5, 10, 0, 0)
D1, D2 = dt.date(2023, 8, 5), dt.date(2023, 8, 6)


def _col(spark, values, name="t", typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {typ}")


def _ordered(df, col):
    return [r[col] for r in df.orderBy("i").collect()]


def test_e1_strict30(spark):
    df = _col(spark, AGES).select("i", is_recent("t", "strict30").alias("ok"))
    assert _ordered(df, "ok") == [True, True, True, False, False, False, False]


def test_e2_lenient(spark):
    df = _col(spark, AGES).select("i", is_recent("t", "lenient").alias("ok"))
    assert _ordered(df, "ok") == [True, True, True, True, False, False, False]


def test_e3_within_one_hour(spark):
    df = _col(spark, AGES + ["a few seconds ago", "59 minutes ago"]).select(
        "i", is_recent("t", "within", minutes=60).alias("ok"))
    assert _ordered(df, "ok") == [True, True, True, True, True, False, False, True, True]


def test_e4_bad_number_goes_to_quarantine(spark):
    df = classify_age(_col(spark, ["few minutes ago", "5 minutes ago", "an hour ago"]), "t")
    assert _ordered(df, "outcome") == ["quarantine", "pass", "pass"]
    kept, bad = op.split_recent(_col(spark, ["few minutes ago"]), "t")
    assert kept.count() == 0 and bad.count() == 1


def _zip(spark, h, d):
    df = spark.createDataFrame([("S", h, d)], "symbol string, h array<string>, d array<string>")
    items = op.extract_items(df, F.col("h"), F.col("d"), symbol="symbol", feed="A")
    return [(r.pos, r.headline, r.date_text) for r in items.orderBy("pos").collect()]


def test_e5_zip_by_position(spark):
    assert _zip(spark, ["a", "b", "c"], ["x", "y"]) == [(0, "a", "x"), (1, "b", "y"), (2, "c", None)]
    assert _zip(spark, ["a"], ["x", "y"]) == [(0, "a", "x")]
    df = spark.createDataFrame([("S", ["a", "b", "c"], ["x", "y"])], "symbol string, h array<string>, d array<string>")
    bad = op.unpaired_items(op.extract_items(df, F.col("h"), F.col("d"), symbol="symbol"))
    assert [r.headline for r in bad.collect()] == ["c"]


def test_e5_pages_without_items_drop_out(spark):
    df = spark.createDataFrame([("S", [], []), ("T", ["a"], ["x"])], "symbol string, h array<string>, d array<string>")
    items = op.extract_items(df, F.col("h"), F.col("d"), symbol="symbol")
    assert [r.symbol for r in items.collect()] == ["T"]


def test_e6_same_day(spark):
    df = _col(spark, ["Aug 05, 2023", "Aug 5, 2023", "Aug 04, 2023", None])
    for mode in ("text", "date"):
        out = df.select("i", is_same_day("t", D1, mode).alias("ok"))
        assert _ordered(out, "ok") == [True, False, False, False]


def _items(spark, rows):
    return spark.createDataFrame(rows, "day date, symbol string, feed string, pos long, headline string")


def _empty_store(spark):
    from newsbeam.schemas import HEADLINES
    return spark.createDataFrame([], HEADLINES)


def test_e7_repeat_key(spark):
    rows = [(D1, "S", "A", 0, "X"), (D1, "S", "A", 1, "X"), (D1, "S", "A", 2, "x"),
            (D1, "T", "A", 3, "X"), (D2, "S", "A", 4, "X")]
    out = op.first_occurrence(_items(spark, rows))
    assert sorted(r.pos for r in out.collect()) == [0, 2, 3, 4]


def test_e8_first_write_modes(spark):
    batch = _items(spark, [(D1, "S", "A", 0, "X"), (D1, "S", "A", 1, "X")])
    assert op.merge_day(_empty_store(spark), batch, AS_OF).count() == 1
    assert op.merge_day(_empty_store(spark), batch, AS_OF, first_write="keep_all").count() == 2


def test_e8_later_merge_dedupes_against_store_and_batch(spark):
    stored = op.to_record(_items(spark, [(D1, "S", "A", 0, "X")]), AS_OF)
    batch = _items(spark, [(D1, "S", "B", 0, "X"), (D1, "S", "B", 1, "Y"), (D1, "S", "B", 2, "Y")])
    for mode in ("dedupe", "keep_all"):
        merged = op.merge_day(stored, batch, AS_OF, first_write=mode)
        assert sorted(r.headline for r in merged.collect()) == ["X", "Y"]


def test_e9_e17_empty_symbol_scores_zero(spark):
    universe = spark.createDataFrame([(D1, "S", 0), (D1, "E", 1)], "day date, symbol string, ord int")
    lab = spark.createDataFrame([(D1, "S", 1, False)], "day date, symbol string, label int, processed boolean")
    out = {r.symbol: r.score for r in op.net_score(lab, universe).collect()}
    assert out == {"S": 1, "E": 0}
    nested = op.nest_day(_empty_store(spark), day_symbols=universe)
    rows = nested.collect()
    assert len(rows) == 2 and all(r.records == [] for r in rows)
    back = op.unnest_day(nested)
    assert back.count() == 2 and back.where(F.col("headline").isNotNull()).count() == 0


def test_e11_only_unprocessed(spark):
    lab = spark.createDataFrame([(D1, "S", 1, True), (D1, "S", -1, False)],
                                "day date, symbol string, label int, processed boolean")
    assert op.net_score(lab).collect()[0].score == 0
    assert op.net_score(lab, only_unprocessed=True).collect()[0].score == -1


def test_e12_exact_labels(spark):
    df = _col(spark, ["negative", "positive", "neutral", "negative.", None])
    assert _ordered(df.select("i", to_label("t", "exact").alias("l")), "l") == [-1, 1, 0, 0, 0]


def test_e13_contains_labels(spark):
    df = _col(spark, ["negative.", "positive or negative", "very positive"])
    assert _ordered(df.select("i", to_label("t", "contains").alias("l")), "l") == [-1, -1, 1]


def test_e14_answer_marker(spark):
    df = _col(spark, ["p Answer: positive", "no marker", "h Answer: h2 Answer: positive"])
    assert _ordered(df.select("i", parse_answer("t").alias("a")), "a") == ["positive", None, "h2 "]


def test_e15_unreadable_is_processed_zero(spark):
    recs = op.to_record(_items(spark, [(D1, "S", "A", 0, "X"), (D1, "S", "A", 1, "Y")]), AS_OF)
    answers = spark.createDataFrame([(0, "neutral"), (1, None)], "pos long, answer string")
    lab = op.label_headlines(recs, op.RecordedScorer(answers, on="pos"))
    out = op.apply_labels(recs, lab).collect()
    assert all(r.processed and r.labelled == 0 for r in out)


def test_e16_write_back_modes(spark):
    recs = op.to_record(_items(spark, [(D1, "S", "A", 0, "X"), (D1, "S", "A", 1, "X")]), AS_OF)
    answers = spark.createDataFrame([(0, "negative"), (1, "negative")], "pos long, answer string")
    lab = op.label_headlines(recs, op.RecordedScorer(answers, on="pos"))
    all_ = sorted((r.pos, r.processed, r.labelled) for r in op.apply_labels(recs, lab, "all").collect())
    first = sorted((r.pos, r.processed, r.labelled)
                   for r in op.apply_labels(recs, lab, "first_match").collect())
    assert all_ == [(0, True, -1), (1, True, -1)]
    assert first == [(0, True, -1), (1, False, None)]
    assert op.net_score(lab).collect()[0].score == -2


def test_e18_ties_keep_key_order(spark):
    scores = spark.createDataFrame([(D1, "S1", 0, 2), (D1, "S2", 1, 3), (D1, "S3", 2, 2)],
                                   "day date, symbol string, ord int, score long")
    ranked = op.rank_scores(scores).orderBy("rank").collect()
    assert [r.symbol for r in ranked] == ["S2", "S1", "S3"]


def test_e19_unknown_day_is_empty(spark):
    from newsbeam.sources.tables import read_day
    assert read_day(_empty_store(spark), dt.date(1999, 1, 1)).count() == 0


def test_e22_strip(spark):
    df = _col(spark, ["\t  a\n", "　b ", "\x1cc\x1f", "  "])
    out = _ordered(df.select("i", strip_ws("t").alias("s")), "s")
    assert out == ["a", "b", "c", ""]
    assert out == [s.strip() for s in ["\t  a\n", "　b ", "\x1cc\x1f", "  "]]


def test_prompt_and_messages(spark):
    from newsbeam.functions.answers import render_prompt, render_prompt_py, to_messages
    df = _col(spark, ["BTC up 5%", None])
    rows = df.select("i", render_prompt("t").alias("p"), to_messages(render_prompt("t")).alias("m")) \
        .orderBy("i").collect()
    assert rows[0].p == render_prompt_py("BTC up 5%")
    assert rows[0].p.endswith("Input: BTC up 5%.\nAnswer: ")
    assert rows[1].p is None
    assert [m.role for m in rows[0].m] == ["system", "user"]


def test_seed_urls_and_unknown(spark):
    from newsbeam.sources.tables import symbol_dim_df, symbols_df
    syms = symbols_df(spark, ["BTC", "ETH", "ZZZ"])
    dim = symbol_dim_df(spark, {"BTC": "bitcoin", "ETH": "ethereum"})
    urls = {r.symbol: r.url for r in op.seed_urls(syms, dim, "slug_news").collect()}
    assert urls == {"BTC": "https://feed-a.example/currencies/bitcoin/news",
                    "ETH": "https://feed-a.example/currencies/ethereum/news"}
    assert [r.symbol for r in op.unknown_symbols(syms, dim).collect()] == ["ZZZ"]
    search = {r.symbol: r.url for r in op.seed_urls(syms, style="search").collect()}
    assert search["ZZZ"] == "https://feed-b.example/search?s=ZZZ&sort=1"


def test_schema_of_records(spark):
    recs = op.to_record(_items(spark, [(D1, "S", "A", 0, "X")]), AS_OF)
    types = dict(recs.dtypes)
    assert types["created"] == "timestamp" and types["labelled"] == "int" and types["processed"] == "boolean"
    assert isinstance(recs.schema["pos"].dataType, T.LongType)
