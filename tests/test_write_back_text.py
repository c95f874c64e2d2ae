"""Write-back and landings move no more text than their rows: label keys, rewrites without a second copy."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.session import run_dir
from newsbeam.sources import buckets, store
from newsbeam.sources.store import HEADLINE_COLS

from .conftest import SF001

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
AS_OF = dt.datetime(2024, 1, 2, 12)
SCHEMA = "day date, symbol string, feed string, pos long, headline string, created timestamp, processed boolean, labelled int"


def _records(spark):
    rows = [(D1, "x", "A", 1, "one", AS_OF, False, None), (D1, "x", "B", 2, "one", AS_OF, False, None),
            (D1, None, "A", 3, None, AS_OF, False, None), (D2, "y", "A", 4, "", AS_OF, False, None),
            (D2, "y", "A", 4, "", AS_OF, False, None), (D2, "y", "B", 5, "two", AS_OF, False, None)]
    return spark.createDataFrame(rows, SCHEMA)


def _answers(spark):
    return spark.createDataFrame([(1, "negative"), (2, "positive"), (3, "positive"), (4, "neutral")], "pos long, answer string")


def _rows(df):
    return sorted(map(str, df.select(*HEADLINE_COLS).collect()))


@pytest.mark.parametrize("mode", ["all", "first_match"])
def test_label_keys_write_back_as_labels_do(spark, mode):
    records, scorer = _records(spark), op.RecordedScorer(_answers(spark), on="pos")
    keys = op.label_keys(records, scorer)
    assert "headline" not in keys.columns
    assert _rows(op.apply_labels(records, keys, mode)) == _rows(op.apply_labels(records, op.label_headlines(records, scorer), mode))


def test_label_keys_of_a_scorer_that_reads_the_text(spark):
    records = _records(spark).where("headline IS NOT NULL")
    scorer = op.LexiconScorer(("one",))
    keys = op.label_keys(records, scorer)
    assert "headline" not in keys.columns
    got = {r.pos: r.labelled for r in op.apply_labels(records, keys).collect()}
    assert got == {1: -1, 2: -1, 4: 0, 5: 0}


def _copies_beside(spark, monkeypatch, modules, work):
    """Columns of every table staged while ``work`` runs."""
    from newsbeam import session
    seen = []

    def spy(df, name="stage"):
        seen.append(df.columns)
        return session.staged(df, name)
    for m in modules:
        if hasattr(m, "staged"):
            monkeypatch.setattr(m, "staged", spy)
    work()
    return seen


def test_rewrites_stage_no_text(spark, monkeypatch):
    path, records = run_dir(spark, "wb-store"), _records(spark)
    store.write_day(records.where("feed = 'A'"), path)

    def work():
        store.upsert_days(spark, path, records.where("feed = 'B'"), AS_OF)
        stored = store.read_store(spark, path)
        store.write_labels(spark, path, op.label_keys(stored, op.RecordedScorer(_answers(spark), on="pos")))
    assert not [c for c in _copies_beside(spark, monkeypatch, [store], work) if "headline" in c]
    got = sorted((str(r.headline), r.pos, r.labelled) for r in store.read_store(spark, path).collect())
    assert got == [("", 4, 0), ("", 4, 0), ("None", 3, 1), ("one", 1, -1), ("two", 5, 0)]  # no answer counts 0


def test_bucket_labels_stage_no_text(spark, monkeypatch):
    path, records = run_dir(spark, "wb-buckets"), _records(spark)
    buckets.write_buckets(records, path, 4)
    was = {os.path.join(d, f) for d, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".parquet")}
    labels = op.label_keys(records.where("pos = 1"), op.RecordedScorer(_answers(spark), on="pos"))
    seen = _copies_beside(spark, monkeypatch, [buckets], lambda: buckets.write_labels_buckets(spark, path, labels, buckets=4))
    assert not [c for c in seen if "headline" in c]
    back = buckets.read_buckets(spark, path)
    assert {r.pos: r.labelled for r in back.collect()} == {1: -1, 2: None, 3: None, 4: None, 5: None}
    assert back.count() == 6
    now = {os.path.join(d, f) for d, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".parquet")}
    assert was & now and was - now  # one leaf rewritten, others keep their files


@pytest.mark.parametrize("name", ["apply_labels_all", "write_day_roundtrip", "write_empty_batch", "score_deltas"])
def test_keys_stage_no_copy_of_the_headline_view(spark, monkeypatch, name):
    import __spark_entry__ as E
    from newsbeam.plans import keys
    staged = []
    real = keys.materialize
    monkeypatch.setattr(keys, "materialize", lambda df, n="stage": staged.append(df.columns) or real(df, n))
    E.queries()[name](spark, SF001)
    assert not [c for c in staged if "headline" in c]


def test_answers_are_dealt_once_for_a_stream(spark, monkeypatch):
    """Daily scores: the recorded answers are prepared, not shuffled anew by every micro-batch."""
    from newsbeam.operators import sentiment
    from newsbeam.streaming import cycle
    prepared = []
    real = sentiment.RecordedScorer.prepared

    def spy(self, n):
        prepared.append(real(self, n))
        return prepared[-1]
    monkeypatch.setattr(sentiment.RecordedScorer, "prepared", spy)
    assert cycle.replay_daily_scores(spark, SF001).count() > 0
    assert len(prepared) == 1 and not prepared[0].answers.is_cached


def test_delta_keys_are_those_of_the_headlines(spark):
    from newsbeam.operators.deltas import batch_labels
    records, scorer = _records(spark), op.RecordedScorer(_answers(spark), on="pos")
    a = batch_labels(op.label_headlines(records, scorer)).select("day", "symbol", F.hex("key"), "label")
    b = batch_labels(op.label_keys(records, scorer)).select("day", "symbol", F.hex("key"), "label")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
