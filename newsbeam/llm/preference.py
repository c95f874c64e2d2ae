"""Preference formatting of conversations (operator 2).

A pair is a chosen and a rejected conversation.  Their longest common prefix of
turns (same role and text, turn by turn) is rendered once as the prompt; what
follows it on either side is rendered as that side's completion.  A completion
carries its loss mask as character spans ``begin-end`` joined by ``;``: the
text and end mark of every assistant turn are trained on, headers and the turns
of other roles are masked.

``format_rows`` takes any pairs as long rows, ``format_pairs`` as arrays of turns.  The query builds one pair
per conversation: chosen is the conversation up to its last assistant turn as
recorded, rejected the same turns with that last reply replaced by the last reply
of the next conversation (in order of conv_id, the last one's next is the first),
the usual random negative.  Turns behind the last assistant turn belong to no pair.

Scale: all work on turns is on long rows.  They are range-partitioned by
conversation and place and stored; a turn's place is its rank in its range plus the turns
in the ranges before.  The two sides meet as digests per pair and place, and the common prefix ends at
the smallest place that differs, so a conversation with many turns, or many rows
without conv_id, are many tasks.  The prompt is rendered by range into parts of about
``PART`` characters of one conversation (``pair_parts``).  Only the last step joins the parts of a
conversation, as the query's SQL has one row and one prompt per conversation: there a prompt must
fit a string (2 GB); beyond that the parts are the result to use.

Edge cases: null text or role renders as empty; null and repeated turn numbers
are ordered by turn (null first), role and text; rows without conv_id form one
conversation of their own; a conversation without an assistant turn is paired
with itself, all prompt and empty completions; if the next conversation has no
reply the rejected completion is empty; equal replies give empty completions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage, successors, table

PART = 4_000_000  # characters or bytes after which a part is closed
TURNS = "array<struct<turn:bigint,role:string,text:string>>"
END = "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> ``(conv_id, turns)``, in order."""
    t = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(t)).cast(TURNS).alias("turns"))


def _head(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def spans(turns: Column) -> Column:
    """Character spans of the assistant turns (text and end mark) in ``render(turns)``."""
    end = F.length(F.lit(END))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("s"))

    def step(acc, t):
        begin = acc["at"] + F.length(_head(t))
        stop = begin + F.length(t["text"]) + end
        span = F.concat(begin.cast("string"), F.lit("-"), stop.cast("string"))
        return F.struct(stop.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["s"], F.array(span))).otherwise(acc["s"]).alias("s"))
    return F.aggregate(turns, zero, step, lambda acc: F.array_join(acc["s"], ";"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that two conversations share."""
    n = F.least(F.size(a), F.size(b))
    differs = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: (x["role"] != y["role"]) | (x["text"] != y["text"]))
    first = F.array_position(differs, F.lit(True))
    return F.when(first > 0, first.cast("int") - 1).otherwise(n)


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` with arrays of turns ``chosen_turns`` and ``rejected_turns`` ->
    its other columns with common_turns, prompt, chosen, chosen_mask, rejected,
    rejected_mask."""
    rest = [c for c in pairs.columns if c not in ("chosen_turns", "rejected_turns")]
    p = pairs.withColumn("common_turns", common_turns(F.col("chosen_turns"), F.col("rejected_turns")))
    n = F.col("common_turns")

    def tail(c):
        return F.slice(c, n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    p = p.select(*rest, "common_turns", F.slice("chosen_turns", F.lit(1), n).alias("p"),
                 tail(F.col("chosen_turns")).alias("c"), tail(F.col("rejected_turns")).alias("r"))
    return p.select(*rest, "common_turns", render(F.col("p")).alias("prompt"), render(F.col("c")).alias("chosen"), spans(F.col("c")).alias("chosen_mask"),
                    render(F.col("r")).alias("rejected"), spans(F.col("r")).alias("rejected_mask"))


def next_reply_pairs(turns: DataFrame) -> DataFrame:
    """One pair per conversation: its last reply against that of the next conversation."""
    convs = conversations(turns)
    replies = F.filter(F.transform("turns", lambda t, i: F.struct((i + 1).alias("n"), t["role"].alias("role"), t["text"].alias("text"))), lambda x: x["role"] == "assistant")
    convs = convs.withColumn("last", F.element_at(F.when(F.size(replies) > 0, replies), -1))
    convs = stage(convs, "conversations")
    ring = stage(successors(convs.select("conv_id"), [F.col("conv_id").asc_nulls_last()], ["conv_id"], ["conv_id"]), "conv-ring")
    nxt = convs.select(F.col("conv_id").alias("n_id"), F.col("last.text").alias("reply"))
    given = ring.join(nxt, F.expr("next_conv_id <=> n_id")).select(F.col("conv_id").alias("to_id"), "reply")
    chosen = F.when(F.col("last").isNull(), F.col("turns")).otherwise(F.slice("turns", F.lit(1), F.col("last.n")))
    swap = F.when(F.col("reply").isNull(), F.array().cast(TURNS)).otherwise(
        F.array(F.struct(F.lit(None).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.col("reply").alias("text"))).cast(TURNS))
    rejected = F.when(F.col("last").isNull(), F.col("turns")).otherwise(F.concat(F.slice("turns", F.lit(1), F.col("last.n") - 1), swap))
    return (convs.join(given, F.expr("conv_id <=> to_id"))
            .select("conv_id", chosen.alias("chosen_turns"), rejected.alias("rejected_turns")))


def placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns(conv_id, turn, role, text)`` as two stored tables: the turns with a digest (``mark``) and
    an ``id`` that ascends in a conversation, and per conversation and range (``part``) the first id and
    the number of turns ahead.  ``key`` stands for conv_id and is never null."""
    rows = turns.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("key"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("tie"))  # equal rows spread too
    order = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    rows = rows.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    rows = stage(rows.select("conv_id", "key", "role", "text", _mark(F.col("role"), F.col("text")).alias("mark"), F.monotonically_increasing_id().alias("id")), "turns")
    rows = rows.withColumn("part", F.shiftright("id", 33))
    bounds = rows.groupBy("key", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    ahead = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    bounds = bounds.select("key", "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    return rows, stage(bounds, "turn-bounds")


def _mark(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def marks(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """``(key, place, mark, id)``: the digest of every turn at its place (from 0) in its conversation."""
    return (rows.select("key", "part", "id", "mark").join(bounds, ["key", "part"])
            .select("key", (F.col("ahead") + F.col("id") - F.col("first")).alias("place"), "mark", "id"))


def common_prefix(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``(key, place, mark)`` of both sides -> ``(key, common)``: the number of leading turns that
    the sides of a pair share.  The sides meet per pair and place, so a pair of long
    conversations is many tasks; the smallest place that differs is an aggregate."""
    both = (chosen.select("key", "place", F.col("mark").alias("one"))
            .join(rejected.select("key", "place", F.col("mark").alias("two")), ["key", "place"], "full"))
    differs = F.min(F.when(~F.col("one").eqNullSafe(F.col("two")), F.col("place")))
    return both.groupBy("key").agg(F.coalesce(differs, F.count("*")).alias("common"))


def pair_parts(rows: DataFrame, bounds: DataFrame, cuts: DataFrame, part: int = PART) -> DataFrame:
    """The turns of one side in parts, ``(key, place, prompt, turns, role, body)``, those of a conversation in
    order of place: the first ``common`` turns rendered, in parts of about ``part`` bytes, and each turn
    behind them up to ``last_id`` (null: all) as it is.  ``cuts(key, common, last_id)`` has a row per conversation."""
    ends = bounds.join(cuts.select("key", "common", "last_id"), "key").withColumn("cut", F.col("first") + F.col("common") - F.col("ahead"))
    near = (rows.select("key", "part", "id", "role", "text").join(ends, ["key", "part"])
            .where(F.col("last_id").isNull() | (F.col("id") <= F.col("last_id"))))
    prompt = F.col("id") < F.col("cut")
    body = F.when(prompt, F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit(END))).otherwise(F.col("text")).cast("binary")
    near = near.sortWithinPartitions("key", "id").select("key", "id", prompt.alias("prompt"), "role", body.alias("body"))
    names = ["key", "place", "prompt", "turns", "role", "body"]
    shape = pa.schema(list(zip(names, [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary()], strict=True)))

    def run(batches):
        head, held, size = None, [], 0  # head: key, first id, prompt, role

        def close():
            nonlocal held, size
            key, place, prompt, role = head
            values = [[key], [place], [prompt], [len(held)], [role], [b"".join(held)]]
            held, size = [], 0
            return pa.RecordBatch.from_pydict(dict(zip(names, values, strict=True)), schema=shape)
        for batch in batches:
            for n, (key, at, prompt, role) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                if held and (not prompt or not head[2] or key != head[0] or size >= part):
                    yield close()
                if not held:
                    head = (key, at, prompt, None if prompt else role)
                held.append(batch.column(4)[n].as_py())
                size += len(held[-1])
        if held:
            yield close()
    parts = near.mapInArrow(run, "key string, place long, prompt boolean, turns long, role string, body binary")
    return parts.withColumn("body", F.col("body").cast("string"))


def _gather(parts: DataFrame) -> DataFrame:
    """``(key, prompt, tail)``: the rendered prompt and the turns behind it, a row per conversation."""
    p = parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "prompt", "role", "body"))).alias("parts"))
    tail = F.transform(F.filter("parts", lambda x: ~x["prompt"]), lambda x: F.struct(x["place"].alias("turn"), x["role"].alias("role"), x["body"].alias("text")))
    return p.select("key", F.array_join(F.transform(F.filter("parts", lambda x: x["prompt"]), lambda x: x["body"]), "").alias("prompt"), tail.cast(TURNS).alias("tail"))


def _completions(pairs: DataFrame) -> DataFrame:
    c, r = F.col("c"), F.col("r")
    return pairs.select("conv_id", F.col("common").cast("int").alias("common_turns"), "prompt", render(c).alias("chosen"), spans(c).alias("chosen_mask"),
                        render(r).alias("rejected"), spans(r).alias("rejected_mask"))


def format_rows(chosen: DataFrame, rejected: DataFrame, part: int = PART) -> DataFrame:
    """``format_pairs`` for long rows: any two tables ``(conv_id, turn, role, text)`` whose
    conversations of one conv_id are the sides of a pair (a missing side is empty)."""
    one, two = placed(chosen), placed(rejected)
    ids = one[0].select("key", "conv_id").union(two[0].select("key", "conv_id")).distinct()
    cuts = stage(common_prefix(marks(*one), marks(*two)).join(ids, "key").withColumn("last_id", F.lit(None).cast("long")), "pair-cuts")
    left = _gather(pair_parts(*one, cuts, part)).withColumnRenamed("tail", "c")
    right = _gather(pair_parts(*two, cuts, part).where("NOT prompt")).select("key", F.col("tail").alias("r"))
    none = F.array().cast(TURNS)
    sides = cuts.join(left, "key", "left").join(right, "key", "left")
    return _completions(sides.select("conv_id", "common", F.coalesce("prompt", F.lit("")).alias("prompt"), F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r")))


def next_reply_parts(turns: DataFrame, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """The pairs of ``next_reply_pairs`` on long rows: ``(key, conv_id, common, last_id, reply)``, a row
    per conversation, and the chosen side's parts (``pair_parts``)."""
    rows, bounds = placed(turns)
    reply = F.when(F.col("role") == "assistant", F.struct("id", "text"))
    last = stage(rows.groupBy("key", "conv_id").agg(F.max(reply).alias("last")), "last-replies")
    ring = stage(successors(last.select("conv_id", "key"), [F.col("conv_id").asc_nulls_last()], ["key"], ["key"]), "conv-ring")
    given = ring.join(last.select(F.col("key").alias("next_key"), F.col("last.text").alias("reply")), "next_key").select("key", "reply")
    pairs = stage(last.join(given, "key").select("key", "conv_id", F.col("last.id").alias("last_id"), "reply"), "pairs")
    # chosen: the turns up to the last reply; rejected: the same with the reply of the next conversation in its place
    at = stage(marks(rows, bounds), "turn-marks")
    ends = pairs.select("key", "last_id")
    chosen = at.join(ends, "key").where("last_id IS NULL OR id <= last_id")
    swapped = at.join(pairs.select("key", "reply", F.col("last_id").alias("id")), ["key", "id"]).where("reply IS NOT NULL")
    swapped = swapped.select("key", "place", _mark(F.lit("assistant"), F.col("reply")).alias("mark"))
    rejected = chosen.where("last_id IS NULL OR id < last_id").select("key", "place", "mark").unionByName(swapped)
    pairs = stage(pairs.join(common_prefix(chosen, rejected), "key"), "pair-cuts")
    return pairs, pair_parts(rows, bounds, pairs, part)


def next_reply_rows(turns: DataFrame, part: int = PART) -> DataFrame:
    """``format_pairs(next_reply_pairs(turns))`` without an array of all turns of a conversation."""
    pairs, parts = next_reply_parts(turns, part)
    sides = pairs.join(_gather(parts), "key")
    # rejected: what is left of the chosen side but its last reply, then the other reply unless it is common
    before = F.filter("tail", lambda t: F.col("last_id").isNull() | (t["turn"] < F.col("last_id")))
    differs = F.col("reply").isNotNull() & F.exists("tail", lambda t: t["turn"] == F.col("last_id"))
    other = F.array(F.struct(F.lit(None).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.col("reply").alias("text"))).cast(TURNS)
    rejected = F.concat(before, F.when(differs, other).otherwise(F.array().cast(TURNS)))
    return _completions(sides.select("conv_id", "common", "prompt", F.col("tail").alias("c"), rejected.alias("r")))


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_reply_rows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


_R = "list_aggregate(list_transform({0}, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', '')"
_M = ("list_aggregate(list_transform(list_filter(range(1, len({0}) + 1), lambda i: {0}[i].role = 'assistant'), lambda i: "
      "(coalesce(list_sum(list_transform({0}[1:i - 1], lambda t: length(t.role) + length(t.text) + 13)), 0)::BIGINT + 14)::VARCHAR || '-' || "
      "(list_sum(list_transform({0}[1:i], lambda t: length(t.role) + length(t.text) + 13))::BIGINT)::VARCHAR), 'string_agg', ';')")

OP2_SQL = f"""
WITH c AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t FROM conversations GROUP BY conv_id),
l AS (SELECT *, list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) AS k FROM c),
n AS (SELECT *, CASE WHEN lead(conv_id) OVER w IS NULL AND row_number() OVER w = count(*) OVER () THEN first_value(t[k].text) OVER w ELSE lead(t[k].text) OVER w END AS reply
      FROM l WINDOW w AS (ORDER BY conv_id NULLS LAST)),
p AS (SELECT conv_id, CASE WHEN k IS NULL THEN t ELSE t[1:k] END AS a,
             CASE WHEN k IS NULL THEN t WHEN reply IS NULL THEN t[1:k - 1] ELSE list_append(t[1:k - 1], {{'role': 'assistant', 'text': reply}}) END AS b FROM n),
q AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])) - 1, least(len(a), len(b)))::INTEGER AS m FROM p),
s AS (SELECT conv_id, m, a[1:m] AS x, a[m + 1:] AS y, b[m + 1:] AS z FROM q)
SELECT conv_id, m AS common_turns, coalesce({_R.format('x')}, '') AS prompt, coalesce({_R.format('y')}, '') AS chosen, coalesce({_M.format('y')}, '') AS chosen_mask,
       coalesce({_R.format('z')}, '') AS rejected, coalesce({_M.format('z')}, '') AS rejected_mask FROM s
"""
