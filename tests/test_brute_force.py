"""Native operators against brute-force Python versions of the same rules,
on generated inputs (hypothesis draws the cases, one Spark job checks them all)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsbeam import operators as op
from newsbeam.functions.answers import parse_answer, to_label
from newsbeam.functions.text import first_line, strip_ws
from newsbeam.operators.recency import is_recent

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

# --------------------------------------------------------------------------- python rules


def py_first_int(x):
    words = x.split()
    if not words:
        return None
    try:
        return int(words[0])
    except ValueError:
        return None


def py_strict30(x):
    if x == "an hour ago":
        return True
    if "minutes" in x:
        n = py_first_int(x)
        return n is not None and n <= 30
    return False


def py_lenient(x):
    return x == "an hour ago" or "minutes" in x


def py_parse(x):
    parts = x.split("Answer: ")
    return parts[1] if len(parts) > 1 else None


def py_label(a, mode):
    if a is None:
        return 0
    if mode == "exact":
        return -1 if a == "negative" else 1 if a == "positive" else 0
    return -1 if "negative" in a else 1 if "positive" in a else 0


def py_merge(stored, batch):
    """The reference's loop: per (day, symbol), keep stored, then each batch
    item in order whose headline is not in the list yet."""
    out = list(stored)
    seen = {(d, s, h) for d, s, h, _ in stored}
    for d, s, h, p in sorted(batch, key=lambda r: r[3]):
        if (d, s, h) not in seen:
            seen.add((d, s, h))
            out.append((d, s, h, p))
    return sorted(out)


# --------------------------------------------------------------------------- strategies

SPACES = [" ", "\t", "\n", "\u00a0", "\u2003", "\u3000", "\x1c"]
word = st.one_of(st.integers(-99, 120).map(str), st.sampled_from(["a", "an", "few", "+5", "05", "x1"]))
age = st.one_of(
    st.sampled_from(["an hour ago", "a minute ago", "an hour ago today", "a few seconds ago", "minutes"]),
    st.tuples(word, st.sampled_from([" minutes ago", " hours ago", "  minutes", " minute ago"]))
    .map("".join),
    st.tuples(st.sampled_from(SPACES), word, st.sampled_from([" minutes ago", "minutes"])).map("".join),
)
spacey = st.lists(st.one_of(st.sampled_from(SPACES), st.text("abc XY", max_size=3)), max_size=8).map("".join)
answer = st.one_of(st.none(), st.sampled_from(["negative", "positive", "neutral", "negative.", "very positive",
                                               "positive or negative", "Negative", ""]))
generated = st.lists(st.sampled_from(["p ", "Answer: ", "positive", "x", "\n", "Answer:"]), max_size=6).map("".join)


def test_recency_rules(spark):
    @SETTINGS
    @given(st.lists(age, min_size=1, max_size=60))
    def check(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = {r.i: (r.s, r.l) for r in df.select("i", is_recent("t", "strict30").alias("s"),
                                                   is_recent("t", "lenient").alias("l")).collect()}
        assert got == {i: (py_strict30(t), py_lenient(t)) for i, t in enumerate(texts)}
    check()


def test_strip_and_first_line(spark):
    @SETTINGS
    @given(st.lists(spacey, min_size=1, max_size=60))
    def check(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = {r.i: (r.s, r.f) for r in df.select("i", strip_ws("t").alias("s"),
                                                   first_line("t").alias("f")).collect()}
        assert got == {i: (t.strip(), t.split("\n", 1)[0]) for i, t in enumerate(texts)}
    check()


def test_answers_and_labels(spark):
    @SETTINGS
    @given(st.lists(st.tuples(generated, answer), min_size=1, max_size=60))
    def check(rows):
        df = spark.createDataFrame([(i, g, a) for i, (g, a) in enumerate(rows)], "i int, g string, a string")
        got = {r.i: (r.p, r.e, r.c) for r in df.select(
            "i", parse_answer("g").alias("p"), to_label("a", "exact").alias("e"),
            to_label("a", "contains").alias("c")).collect()}
        assert got == {i: (py_parse(g), py_label(a, "exact"), py_label(a, "contains"))
                       for i, (g, a) in enumerate(rows)}
    check()


def test_merge_day_matches_the_loop(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    item = st.tuples(st.sampled_from(days), st.sampled_from(["S", "T"]), st.sampled_from(["X", "x", "Y", "Z"]))

    @SETTINGS
    @given(st.lists(item, max_size=12), st.lists(item, max_size=25))
    def check(stored_keys, batch_keys):
        stored = [(d, s, h, i) for i, (d, s, h) in enumerate(stored_keys)]
        batch = [(d, s, h, 100 + i) for i, (d, s, h) in enumerate(batch_keys)]
        schema = "day date, symbol string, headline string, pos long"
        sdf = spark.createDataFrame(stored, schema).withColumn("feed", F.lit("A"))
        bdf = spark.createDataFrame(batch, schema).withColumn("feed", F.lit("B"))
        stored_recs = op.to_record(sdf, dt.datetime(2024, 1, 2))
        merged = op.merge_day(stored_recs, bdf, dt.datetime(2024, 1, 2))
        got = sorted((r.day, r.symbol, r.headline, r.pos) for r in merged.collect())
        assert got == py_merge(stored, batch)
    check()


def py_first_match(records, labels):
    """The reference's write-back: each scored copy updates the first stored
    element with the same (day, symbol, headline)."""
    out = {pos: (False, None) for _, _, _, pos in records}
    ordered = sorted(records, key=lambda r: r[3])
    for d, s, h, pos in sorted(labels, key=lambda r: r[3]):
        first = next(r for r in ordered if (r[0], r[1], r[2]) == (d, s, h))
        out[first[3]] = (True, labels[(d, s, h, pos)])
    return out


def test_first_match_write_back_matches_the_loop(spark):
    day = dt.date(2024, 1, 1)
    item = st.tuples(st.sampled_from(["S", "T"]), st.sampled_from(["X", "Y", "Z"]), st.sampled_from([-1, 0, 1]))

    @SETTINGS
    @given(st.lists(item, min_size=1, max_size=20))
    def check(items):
        rows = [(day, s, "A", i, h, lab) for i, (s, h, lab) in enumerate(items)]
        df = spark.createDataFrame(rows, "day date, symbol string, feed string, pos long, headline string, label int")
        recs = op.to_record(df.drop("label"), dt.datetime(2024, 1, 1))
        labels = op.to_record(df, dt.datetime(2024, 1, 1))
        got = {r.pos: (r.processed, r.labelled) for r in op.apply_labels(recs, labels, "first_match").collect()}
        lab = {(day, s, h, i): label for i, (s, h, label) in enumerate(items)}
        assert got == py_first_match([(day, s, h, i) for i, (s, h, _) in enumerate(items)], lab)
    check()


def py_merge_keep_all(stored, batch):
    """First write of a day keeps the batch as it is; later merges dedupe."""
    stored_days = {d for d, _, _, _ in stored}
    fresh = [r for r in batch if r[0] not in stored_days]
    later = py_merge(stored, [r for r in batch if r[0] in stored_days])
    return sorted(later + fresh)


def test_merge_day_keep_all_matches_the_loop(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    item = st.tuples(st.sampled_from(days), st.sampled_from(["S", "T"]), st.sampled_from(["X", "Y"]))

    @SETTINGS
    @given(st.lists(item, max_size=8), st.lists(item, max_size=20))
    def check(stored_keys, batch_keys):
        stored = [(d, s, h, i) for i, (d, s, h) in enumerate(stored_keys)]
        batch = [(d, s, h, 100 + i) for i, (d, s, h) in enumerate(batch_keys)]
        schema = "day date, symbol string, headline string, pos long"
        sdf = op.to_record(spark.createDataFrame(stored, schema).withColumn("feed", F.lit("A")),
                           dt.datetime(2024, 1, 2))
        bdf = spark.createDataFrame(batch, schema).withColumn("feed", F.lit("B"))
        merged = op.merge_day(sdf, bdf, dt.datetime(2024, 1, 2), first_write="keep_all")
        got = sorted((r.day, r.symbol, r.headline, r.pos) for r in merged.collect())
        assert got == py_merge_keep_all(stored, batch)
    check()
