"""Properties (idempotence, round trips, partition independence) and plan shapes."""

import datetime as dt

from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.plans import keys
from newsbeam.plans.keys import QUERIES
from newsbeam.sources.fixtures import headline_records, headlines_view

from .conftest import SF01

AS_OF = dt.datetime(2024, 1, 2, 12, 0, 0)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _recs(spark):
    return headline_records(headlines_view(spark, SF01), AS_OF)


def test_merge_day_idempotent(spark):
    recs = _recs(spark)
    a, b = recs.where("feed = 'A'"), recs.where("feed = 'B'")
    once = op.merge_day(a, b, AS_OF)
    twice = op.merge_day(once, b, AS_OF)
    assert _same(once, twice)


def test_unnest_of_nest_is_identity(spark):
    recs = _recs(spark).drop("doc_id")
    back = op.unnest_day(op.nest_day(recs, part_size=37))
    assert _same(back.select(*recs.columns), recs)


def test_nest_parts_are_bounded(spark):
    nested = op.nest_day(_recs(spark), part_size=37)
    assert nested.agg(F.max(F.size("records"))).first()[0] <= 37


def test_scores_do_not_depend_on_partitioning(spark):
    lab = keys._labelled(spark, SF01)
    a = op.net_score(lab)
    b = op.net_score(lab.repartition(13, "doc_id"))
    c = op.net_score(lab.coalesce(1))
    assert _same(a, b) and _same(a, c)


def test_first_occurrence_under_a_hot_key(spark):
    """A key holding most rows still yields one row, the lowest position."""
    rows = [(dt.date(2024, 1, 1), "HOT", "A", i, "same") for i in range(5000)]
    rows += [(dt.date(2024, 1, 1), "S", "A", i, f"h{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "day date, symbol string, feed string, pos long, headline string")
    out = op.first_occurrence(df.repartition(8))
    hot = out.where("symbol = 'HOT'").collect()
    assert len(hot) == 1 and hot[0].pos == 0
    assert out.count() == 101


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_novel_is_left_anti_without_python(spark):
    plan = _plan(keys.novel_headlines_q(spark, SF01))
    assert "LeftAnti" in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_first_occurrence_pre_aggregates_before_shuffle(spark):
    plan = keys.combine_feeds_q(spark, SF01)._jdf.queryExecution().executedPlan()
    s = plan.toString()
    assert "partial_min" in s


def test_headline_rows_never_shuffle_on_day_alone(spark):
    """Only partial aggregates (one row per day and task) are exchanged on day."""
    lines = _plan(keys.read_day_q(spark, SF01)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(day#" in line and "," not in line.split("hashpartitioning(")[1].split(")")[0]:
            assert "partial_" in lines[i + 1], lines[i + 1]


def test_read_day_pushes_time_range_to_scan(spark):
    s = keys.read_day_q(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-02" in s


def test_scan_prunes_columns(spark):
    s = _plan(keys.score_lexicon_q(spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in s
    s = _plan(keys.QUERIES["same_day"](spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in s


def test_multi_branch_keys_scan_text_once(spark):
    """Keys that read H in several branches stage it, so document text is scanned once."""
    from newsbeam.plans.keys import _feeds
    a, b = _feeds(spark, SF01)
    s = _plan(op.merge_day(a, b, AS_OF))
    assert "text:string" not in s


def test_native_keys_have_no_python(spark):
    for name in ("score_lexicon", "extract_zip", "recent_strict30", "rank_scores"):
        s = _plan(keys.QUERIES[name](spark, SF01))
        assert "Python" not in s and "ArrowEval" not in s, name


def test_no_plan_hazards_in_any_key(spark):
    """No cartesian / nested-loop joins and no single-partition exchange in any key."""
    import __spark_entry__ as E
    from tools.plan_audit import audit
    for name, fn in QUERIES.items():
        assert audit(fn(spark, SF01))["hazards"] == [], name


def test_nest_splits_parts_by_run_and_feed(spark):
    rows = [(dt.date(2024, 1, 1), "S", "A", 0, "x"), (dt.date(2024, 1, 1), "S", "B", 0, "y"),
            (dt.date(2024, 1, 1), "S", "A", 1, "z")]
    recs = op.to_record(spark.createDataFrame(rows, "day date, symbol string, feed string, pos long, headline string"),
                        AS_OF)
    nested = op.nest_day(recs, part_size=10).orderBy("feed").collect()
    assert [(r.feed, [x.headline for x in r.records]) for r in nested] == [("A", ["x", "z"]), ("B", ["y"])]
    docs = op.day_documents(op.nest_day(recs, part_size=10)).orderBy("feed").collect()
    assert [sorted(d.symbol_headlines) for d in docs] == [["S"], ["S"]]
    assert _same(op.unnest_day(op.nest_day(recs, part_size=1)).select(*recs.columns), recs)


def test_merge_symbol_maps_keeps_batch_symbols_without_news(spark):
    d = dt.date(2024, 1, 1)
    schema = "day date, symbol string, feed string, pos long, headline string"
    stored = op.to_record(spark.createDataFrame([(d, "S", "A", 0, "x")], schema), AS_OF)
    batch = spark.createDataFrame([(d, "S", "B", 0, "x"), (d, "T", "B", 1, "t"), (d, "T", "B", 2, "t")], schema)
    got = {r.symbol: (r.n_stored, r.n_added, r.n_total) for r in op.merge_symbol_maps(stored, batch).collect()}
    assert got == {"S": (1, 0, 1), "T": (0, 1, 1)}
