"""Store round trips, prompt files, and streaming against batch."""

import datetime as dt

from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.session import run_dir
from newsbeam.sources import store
from newsbeam.sources.fixtures import headline_records, headlines_view
from newsbeam.sources.tables import read_prompts
from newsbeam.streaming import cycle as streams

from .conftest import SF01

AS_OF = dt.datetime(2024, 1, 2, 12, 0, 0)


def test_write_day_replaces_only_written_days(spark):
    recs = headline_records(headlines_view(spark, SF01), AS_OF)
    path = run_dir(spark, "t-store")
    store.write_day(recs, path)
    before = store.read_store(spark, path).groupBy("day").count().collect()
    one = recs.where(F.col("day") == dt.date(2024, 1, 1)).limit(3)
    store.write_day(one, path)
    after = {r.day: r["count"] for r in store.read_store(spark, path).groupBy("day").count().collect()}
    assert after[dt.date(2024, 1, 1)] == 3
    assert all(after[r.day] == r["count"] for r in before if r.day != dt.date(2024, 1, 1))
    # FLT-5: an empty frame leaves the table as it was
    store.write_day(recs.limit(0), path)
    assert store.read_store(spark, path).count() == sum(after.values())


def test_upsert_is_idempotent(spark):
    recs = headline_records(headlines_view(spark, SF01), AS_OF)
    a, b = recs.where("feed = 'A'"), recs.where("feed = 'B'")
    path = run_dir(spark, "t-upsert")
    store.write_day(a, path)
    store.upsert_days(spark, path, b, AS_OF)
    n1 = store.read_store(spark, path).count()
    store.upsert_days(spark, path, b, AS_OF)
    assert store.read_store(spark, path).count() == n1 == 5000 + 1513


def test_write_labels_and_snapshot(spark):
    recs = headline_records(headlines_view(spark, SF01), AS_OF).drop("doc_id")
    path = run_dir(spark, "t-labels")
    store.write_day(recs, path)
    stored = store.read_store(spark, path)
    # labels must not stay bound to the files the write-back replaces
    lab = op.label_headlines(stored, op.LexiconScorer()).checkpoint(eager=True)
    store.write_labels(spark, path, lab)
    after = store.read_store(spark, path)
    assert after.where(~F.col("processed")).count() == 0
    ranked = op.rank_scores(op.net_score(lab, op.day_symbols(lab)))
    snap = run_dir(spark, "t-snap")
    store.append_snapshot(ranked, snap, AS_OF)
    store.append_snapshot(ranked, snap, AS_OF)  # replay of the same run replaces it
    assert store.read_snapshots(spark, snap).count() == ranked.count()
    m = op.snapshot_map(store.read_snapshots(spark, snap)).collect()
    assert len(m) == 30 and all(len(r.sentiments) == 20 for r in m)


def test_read_day_prunes_partitions(spark):
    recs = headline_records(headlines_view(spark, SF01), AS_OF).drop("doc_id")
    path = run_dir(spark, "t-prune")
    store.write_day(recs, path)
    df = store.read_day(store.read_store(spark, path), dt.date(2024, 1, 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-02" in plan
    assert df.count() == 339


def test_read_prompts(spark, tmp_path):
    texts = ["Instruction: x\nInput: a.\nAnswer: ", "Instruction: x\nInput: Input: b\nAnswer: ",
             "Instruction: y \nInput: c.      \nAnswer: "]
    for i, t in enumerate(texts):
        (tmp_path / f"p{i}.txt").write_text(t)
    got = sorted(r.prompt for r in read_prompts(spark, str(tmp_path)).collect())
    assert got == sorted(texts)


def test_prompt_file_through_a_model(spark, tmp_path):
    """SRC-5 -> UDF-2 -> UDF-3: a prompt file run through a model factory."""
    from newsbeam.functions.answers import render_prompt_py
    texts = [render_prompt_py("Growth plan for boards")] * 6 + [
        render_prompt_py("Input: Price prediction, coming soon?"),
        "Instruction: x \nInput: Mainnet live.      \nAnswer: "]
    for i, t in enumerate(texts):
        (tmp_path / f"p{i}.txt").write_text(t)
    out = op.generate_answers(read_prompts(spark, str(tmp_path)), op.lexicon_model()).collect()
    assert len(out) == 8
    assert all(r.generated == r.prompt + "neutral" and r.answer == "neutral" for r in out)


def test_cycle_runs_over_a_stream(spark):
    """STR-1: one streaming query whose batches merge, score and snapshot."""
    h = headlines_view(spark, SF01).select("day", "symbol", "feed", F.col("doc_id").alias("pos"),
                                           "headline", "seen_at")
    src = run_dir(spark, "t-cycle-src")
    h.write.parquet(src)
    stream = streams.with_event_time(spark.readStream.schema(h.schema).parquet(src)).drop("seen_at")
    store_path, snap_path = run_dir(spark, "t-cycle-store"), run_dir(spark, "t-cycle-snap")
    cycle = streams.make_cycle(spark, store_path, snap_path, op.LexiconScorer())
    q = streams.run_cycle(stream, cycle, run_dir(spark, "t-cycle-ck"), available_now=True)
    q.awaitTermination()
    stored = store.read_store(spark, store_path)
    assert stored.count() == 3356  # one batch: both feeds merged, repeats removed
    assert stored.where(~F.col("processed")).count() == 0
    assert store.read_snapshots(spark, snap_path).count() == 600


def test_stream_equals_batch(spark):
    streamed = streams.replay_dedupe(spark, SF01)
    batch = headlines_view(spark, SF01).select("day", "symbol", "headline").distinct()
    assert streamed.count() == 3356
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_touched_days_join_is_broadcast_and_pruned(spark):
    from newsbeam.operators.merge import day_set
    recs = headline_records(headlines_view(spark, SF01), AS_OF).drop("doc_id")
    path = run_dir(spark, "t-dpp")
    store.write_day(recs, path)
    batch = recs.where(F.col("day") == dt.date(2024, 1, 2))
    touched = store.read_store(spark, path).join(day_set(batch), "day", "left_semi")
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan
    assert "SortMergeJoin" not in plan
    assert touched.count() == 339


def test_dedupe_by_store_is_exactly_once(spark):
    h = headlines_view(spark, SF01).select("day", "symbol", "headline", "doc_id",
                                           F.col("seen_at").cast("timestamp").alias("event_time"))
    first, second = h.where("doc_id < 500"), h.where("doc_id >= 300")
    seen, out = run_dir(spark, "t-seen"), run_dir(spark, "t-out")
    write = streams.dedupe_batch_writer(spark, seen, out)
    write(first, 0)
    write(first, 0)  # a replay of batch 0 replaces its own output
    write(second, 1)
    got = spark.read.parquet(out)
    keys = h.select("day", "symbol", "headline").distinct()
    assert got.count() == keys.count() == 3356
    assert got.select("day", "symbol", "headline").exceptAll(keys).count() == 0


def test_stream_dedupe_by_store_equals_batch(spark):
    streamed = streams.replay_dedupe_by_store(spark, SF01).select("day", "symbol", "headline")
    batch = headlines_view(spark, SF01).select("day", "symbol", "headline").distinct()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_staged_copies_are_removed(spark):
    import os
    recs = headline_records(headlines_view(spark, SF01), AS_OF)
    path = run_dir(spark, "t-clean")
    runs = os.path.dirname(path.replace("file:", ""))
    before = {d for d in os.listdir(runs) if d.startswith("merge-")} if os.path.isdir(runs) else set()
    store.write_day(recs.where("feed = 'A'"), path)
    store.upsert_days(spark, path, recs.where("feed = 'B'"), AS_OF)
    after = {d for d in os.listdir(runs) if d.startswith("merge-")}
    assert after == before
    assert store.read_store(spark, path).count() == 6513
