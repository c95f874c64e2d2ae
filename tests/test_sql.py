"""SQL functions agree with the Column helpers and stay JVM-side."""

import datetime as dt

from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.functions.answers import parse_answer, render_prompt, to_label
from newsbeam.functions.text import element_text, first_line, first_word_int, strip_ws
from newsbeam.operators.recency import age_minutes, is_recent, is_same_day
from newsbeam.sql import register_functions, register_views

from .conftest import SF01


def test_sql_functions_match_columns(spark):
    register_functions(spark)
    register_views(spark, sf_dir=SF01)
    d = dt.date(2024, 1, 2)
    by_sql = spark.sql("""
      SELECT doc_id, nb_strip(headline) AS s, nb_first_word_int(age_text) AS n, nb_age_minutes(age_text) AS m,
             nb_recent(age_text, 'strict30') AS r1, nb_recent(age_text, 'lenient') AS r2,
             nb_recent(age_text, 'within60') AS r3, nb_same_day(day_text, DATE'2024-01-02') AS sd,
             nb_day_key(day) AS dk, nb_render_prompt(headline) AS p,
             nb_parse_answer(concat(nb_render_prompt(headline), 'positive')) AS a,
             nb_label(CASE WHEN doc_id % 3 = 0 THEN 'negative' ELSE 'positive.' END) AS l1,
             nb_label_contains(CASE WHEN doc_id % 3 = 0 THEN 'negative' ELSE 'positive.' END) AS l2,
             nb_lexicon_answer(headline) AS lx, nb_element_text(concat('<b>', headline, ' &amp;</b>')) AS et
      FROM h_ages""")
    h = spark.table("h_ages")
    ans = F.when(F.col("doc_id") % 3 == 0, F.lit("negative")).otherwise(F.lit("positive."))
    by_col = h.select(
        "doc_id", strip_ws("headline").alias("s"), first_word_int("age_text").alias("n"),
        age_minutes("age_text").alias("m"), is_recent("age_text", "strict30").alias("r1"),
        is_recent("age_text", "lenient").alias("r2"), is_recent("age_text", "within", 60).alias("r3"),
        is_same_day("day_text", d).alias("sd"), F.date_format("day", "MMM dd, yyyy").alias("dk"),
        render_prompt("headline").alias("p"),
        parse_answer(F.concat(render_prompt("headline"), F.lit("positive"))).alias("a"),
        to_label(ans, "exact").alias("l1"), to_label(ans, "contains").alias("l2"),
        F.when(F.col("headline").rlike(op.LexiconScorer().pattern), "negative").otherwise("neutral").alias("lx"),
        element_text(F.concat(F.lit("<b>"), F.col("headline"), F.lit(" &amp;</b>"))).alias("et"))
    assert by_sql.count() == 10000
    assert by_sql.exceptAll(by_col).count() == 0 and by_col.exceptAll(by_sql).count() == 0
    plan = by_sql._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_first_line_function(spark):
    register_functions(spark)
    r = spark.sql("SELECT nb_first_line('a\nb') AS x").first()
    assert r.x == "a"
    assert spark.range(1).select(first_line(F.lit("a\nb")).alias("x")).first().x == "a"


def test_select_css_udtf(spark):
    register_functions(spark)
    register_views(spark, sf_dir=SF01)
    sql = spark.sql("SELECT p.page_id, s.pos, s.text FROM pages p, LATERAL nb_select_css(p.html, 'div.ad') s")
    df = op.extract_css(spark.table("pages"), {"ad": "div.ad"}).select("page_id", "pos", "text")
    assert sql.count() == 250
    assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0


def test_sql_strip_matches_python(spark):
    register_functions(spark)
    texts = ["\t  a b\n", "　x ", "\x1cc\x1f\x85", "   ", "\r\nq\x0b\x0c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    df.createOrReplaceTempView("ws_cases")
    got = [r.s for r in spark.sql("SELECT i, nb_strip(t) AS s FROM ws_cases ORDER BY i").collect()]
    assert got == [t.strip() for t in texts]


def test_store_views_in_sql(spark):
    import datetime as dt

    from newsbeam.session import run_dir
    from newsbeam.sources import store
    from newsbeam.sources.fixtures import headline_records, headlines_view
    register_functions(spark)
    recs = headline_records(headlines_view(spark, SF01))
    path, snaps = run_dir(spark, "sql-store"), run_dir(spark, "sql-snaps")
    store.write_day(recs, path)
    ranked = op.rank_scores(op.net_score(op.label_headlines(recs, op.LexiconScorer()), op.day_symbols(recs)))
    store.append_snapshot(ranked, snaps, dt.datetime(2024, 1, 2, 12))
    register_views(spark, store_path=path, snapshots_path=snaps)
    by_sql = spark.sql("""SELECT day, symbol, CAST(sum(nb_label(nb_lexicon_answer(headline))) AS BIGINT) AS score
                          FROM headlines GROUP BY day, symbol""")
    by_df = spark.table("scores_snapshot").select("day", "symbol", "score")
    assert by_sql.exceptAll(by_df).count() == 0 and by_df.exceptAll(by_sql).count() == 0


def test_day_documents_carry_key_text(spark):
    from newsbeam.sources.fixtures import headline_records, headlines_view
    docs = op.day_documents(op.nest_day(headline_records(headlines_view(spark, SF01)), 1000))
    assert sorted({r.date for r in docs.select("date").collect()}) == [f"Jan {d:02d}, 2024" for d in range(1, 31)]
