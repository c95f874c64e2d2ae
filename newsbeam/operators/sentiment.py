"""Sentiment as a distributed batch job with a pluggable scorer.

A scorer adds an ``answer`` column (the model's answer text) to a frame:

* ``RecordedScorer``: known answers looked up by key (left join).
* ``LexiconScorer``: a listed-word test as one native ``rlike``.
* ``PandasScorer``: any model behind ``mapInPandas``: the model is built
  once per task by a factory, prompts are rendered and answers parsed around
  it, batches arrive as Arrow record batches.

The shipped scorers are stand-ins for the data path; they are not the
reference's language model and do not reproduce its outputs.
"""

from __future__ import annotations

import re
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.answers import NEGATIVE, NEUTRAL, parse_answer, render_prompt, to_label
from ..functions.keys import HEADLINE_KEY, digest, headline_col
from ..functions.text import strip_ws

# The stand-in lexicon of negative words (lower case, whole words).
NEGATIVE_WORDS = ("trash", "scum", "idiot", "clown", "worthless",
                  "moron", "pathetic", "loser", "stupid", "disgusting")


def lexicon_pattern(words=NEGATIVE_WORDS) -> str:
    """Whole-word alternation; word edges are letters, digits and ``_`` in
    the Unicode sense, written the same for Java regex, RE2 and ``regex``."""
    alt = "|".join(words)
    return rf"(?:^|[^\p{{L}}\p{{N}}_])(?:{alt})(?:[^\p{{L}}\p{{N}}_]|$)"


class RecordedScorer:
    """Answers from a table ``(key..., answer)``; rows without one get null.

    ``hashed``: a task holds its share of the answers in memory, so the rows with the text are shuffled
    but not sorted.  Without it both sides are sorted and may spill: for rows without text, where the
    answers are as many as the rows."""

    def __init__(self, answers: DataFrame, on="doc_id", hashed: bool = True):
        self.answers = answers
        self.on = [on] if isinstance(on, str) else list(on)
        self.hashed = hashed

    def score(self, df: DataFrame, text_col: str = "headline") -> DataFrame:
        answers = self.answers.select(*self.on, "answer")
        return df.join(answers.hint("shuffle_hash") if self.hashed else answers, self.on, "left")

    def prepared(self, partitions: int) -> "RecordedScorer":
        """For a stream joined to a large answer table: hash-partition the
        answers by key and persist them once, so every micro-batch shuffles
        only its own rows (the static side keeps its partitioning)."""
        from pyspark import StorageLevel
        ready = (self.answers.select(*self.on, "answer").repartition(partitions, *self.on)
                 .persist(StorageLevel.MEMORY_AND_DISK))
        return RecordedScorer(ready, self.on, self.hashed)


class LexiconScorer:
    """``negative`` when the text holds a listed word, else ``neutral``."""

    def __init__(self, words=NEGATIVE_WORDS):
        self.pattern = lexicon_pattern(words)

    def score(self, df: DataFrame, text_col: str = "headline") -> DataFrame:
        hit = F.col(text_col).rlike(self.pattern)
        return df.withColumn("answer", F.when(hit, F.lit(NEGATIVE)).otherwise(F.lit(NEUTRAL)))


def lexicon_model(words=NEGATIVE_WORDS) -> Callable[[], Callable[[pd.Series], pd.Series]]:
    """Factory of a stand-in "model": generated text = prompt + answer word.
    It writes one word whatever the length limit."""
    alt = "|".join(words)

    def build(max_length: int | None = None):
        rx = re.compile(rf"(?<!\w)(?:{alt})(?!\w)")  # Unicode word edges, as on the JVM side

        def generate(prompts: pd.Series) -> pd.Series:
            return prompts.map(lambda p: None if p is None else
                               p + (NEGATIVE if rx.search(p) else NEUTRAL))
        return generate
    return build


def _generated(prompt, factory, max_length: int):
    """The model's text for a prompt column: only the prompts travel to Python,
    in Arrow batches.  Marked non-deterministic so that no plan runs the model
    twice for one row."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        generate = factory(max_length)
        for prompts in batches:
            yield generate(prompts)
    return run.asNondeterministic()(prompt)


class PandasScorer:
    """A model run over Arrow batches: ``factory(max_length)`` is called once per
    task and returns ``generate(prompts: Series) -> Series`` of generated text;
    ``max_length`` is the model's generation limit.  Prompts are rendered and
    answers parsed as native columns around it; the answer is the text after
    the ``Answer: `` marker (null without it).  ``chat``: the model answers messages, its text
    is the answer itself, stripped.
    """

    def __init__(self, factory, max_length: int = 512, partitions: int | None = None, chat: bool = False):
        self.factory = factory
        self.chat = chat
        self.max_length = max_length
        # model time dominates: spread rows evenly over ``partitions`` tasks
        # (round robin), so a partition full of one hot symbol is not one task
        self.partitions = partitions

    def score(self, df: DataFrame, text_col: str = "headline") -> DataFrame:
        if self.partitions:
            df = df.repartition(self.partitions)
        if self.chat:
            return df.withColumn("answer", strip_ws(_generated(F.col(text_col), self.factory, self.max_length)))
        gen = _generated(render_prompt(text_col), self.factory, self.max_length)
        return df.withColumn("answer", parse_answer(gen))


def generate_answers(prompts: DataFrame, factory, prompt_col: str = "prompt", max_length: int = 512) -> DataFrame:
    """UDF-2 + UDF-3 on prompts that are already rendered (a prompt file):
    adds the model's ``generated`` text and the parsed ``answer``."""
    out = prompts.withColumn("generated", _generated(F.col(prompt_col), factory, max_length))
    return out.withColumn("answer", parse_answer("generated"))


def score_headlines(df: DataFrame, scorer, text_col: str = "headline") -> DataFrame:
    """UDF-2: add the scorer's ``answer``."""
    return scorer.score(df, text_col)


def raw_answers(df: DataFrame, scorer, text_col: str = "headline") -> DataFrame:
    """UDF-6: the answer per headline, no score."""
    return score_headlines(df, scorer, text_col).select("day", "symbol", text_col, "answer")


def label_headlines(df: DataFrame, scorer, mode: str = "exact", text_col: str = "headline") -> DataFrame:
    """UDF-8: answer and ``label`` (-1/0/+1) per headline."""
    return score_headlines(df, scorer, text_col).withColumn("label", to_label("answer", mode))


IDENTITY = ("day", "symbol", "feed", "created", "pos", "headline")
MATCH = ("day", "symbol", "headline")
IDENTITY_KEY, MATCH_KEY = "identity_key", "match_key"


def _of(df: DataFrame, cols) -> list[str]:
    """``cols`` as ``df`` has them: keyed rows hold ``headline_key`` for the headline."""
    return [headline_col(df) if c == "headline" else c for c in cols]


def label_keys(df: DataFrame, scorer, mode: str = "exact", text_col: str = "headline") -> DataFrame:
    """UDF-8 for a write-back: ``label_headlines`` with the digests that ``apply_labels``
    meets its records by (``identity_key``, ``match_key``) in place of the text.  A scorer
    that looks answers up by other columns gets no text, so none is shuffled to it.  Keyed rows
    hold no text, so only such a scorer can label them."""
    keyed = df.withColumns({IDENTITY_KEY: digest(*[c for c in _of(df, IDENTITY) if c in df.columns]), MATCH_KEY: digest(*_of(df, MATCH))})
    if text_col not in getattr(scorer, "on", (text_col,)):
        text_col = text_col if text_col in df.columns else headline_col(df)
        return label_headlines(keyed.drop(text_col), scorer, mode, text_col)
    return label_headlines(keyed, scorer, mode, text_col).drop(text_col)


def _label_key(labels: DataFrame, name: str, cols):
    return F.col(name) if name in labels.columns else digest(*cols)


def apply_labels(records: DataFrame, labels: DataFrame, mode: str = "all",
                 identity=IDENTITY) -> DataFrame:
    """JN-4 / WIN-2: write labels back into records.

    ``labels`` holds the ``identity`` columns and ``label`` of the scored
    records, or the digests of ``label_keys`` in place of the headline.  Every
    scored record becomes ``processed`` with its label.

    ``all`` (default): each scored record gets its own label.
    ``first_match`` (parity): updates go by (day, symbol, headline) to the
    first stored copy only (earliest ``created``, then lowest ``pos``); with
    several scored copies the one scored last wins; other copies stay
    unprocessed.  Both are grouped aggregates plus equi joins on digests (no
    window over a key, null equals null), so a record's text is shuffled once,
    not sorted (the labels are hashed), and a label carries none.  Keyed records
    (``headline_key`` in place of ``headline``) move no text; they are sorted.
    """
    keep = [c for c in records.columns if c not in ("processed", "labelled")]
    match = _of(records, MATCH)
    hashed = lambda small: small if headline_col(records) == HEADLINE_KEY else small.hint("shuffle_hash")
    order = [c for c in ("created", "pos") if c in records.columns]
    if mode == "all":
        ident = [c for c in _of(records, identity) if c in records.columns]
        # copies share an identity (keep_all): one label each, so the join adds no rows
        own = _label_key(labels, IDENTITY_KEY, ident) if identity == IDENTITY else digest(*ident)
        lab = labels.select(own.alias("_k"), "label").groupBy("_k").agg(F.max("label").alias("_label"))
        j = records.withColumn("_k", digest(*ident)).join(hashed(lab), "_k", "left")
    elif mode == "first_match":
        last = (labels.select(_label_key(labels, MATCH_KEY, match).alias("_m"), "label", *order)
                .groupBy("_m").agg(F.max_by("label", F.struct(*order)).alias("_label")))
        first = (records.select(digest(*match).alias("_m"), *order, digest(*match, *order).alias("_k"))
                 .groupBy("_m").agg(F.min(F.struct(*order, "_k")).alias("_o")))
        target = first.join(last, "_m").select(F.col("_o._k").alias("_k"), "_label")
        j = records.withColumn("_k", digest(*match, *order)).join(hashed(target), "_k", "left")
    else:
        raise ValueError(f"unknown write-back mode {mode!r}")
    hit = F.col("_label").isNotNull()
    return j.select(*keep,
                    F.when(hit, F.lit(True)).otherwise(F.col("processed")).alias("processed"),
                    F.when(hit, F.col("_label")).otherwise(F.col("labelled")).cast("int").alias("labelled"))


def to_messages_frame(df: DataFrame, text_col: str = "text", system: str | None = None) -> DataFrame:
    """UDF-7: chat messages (system + user) per row."""
    from ..functions.answers import SYSTEM_CONTENT, to_messages
    return df.withColumn("messages", to_messages(text_col, system or SYSTEM_CONTENT))


def conversation_turns(conv: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """UDF-7 over a conversation table in long form: one message per row
    ``(id, turn, role, content)``, ordered by ``turn`` within ``id``; no list, so
    a conversation may have any number of turns and nothing is shuffled."""
    return conv.select(id_col, turn_col, "role", F.col("text").alias("content"))


def conversation_messages(conv: DataFrame, part_size: int = 64, id_col: str = "conv_id",
                          turn_col: str = "turn") -> DataFrame:
    """UDF-7 over a conversation table: the turns of a conversation as chat
    messages in turn order, ``(id, part, messages)``.  A part holds at most
    ``part_size`` turns (``turn div part_size``), so a long conversation is
    never collected into one row."""
    part = F.floor(F.col(turn_col) / F.lit(part_size)).cast("long")
    ordered = F.array_sort(F.collect_list(F.struct(turn_col, "role", F.col("text").alias("content"))))
    return (conv.withColumn("part", part)
            .groupBy(id_col, "part")
            .agg(ordered.alias("_m"))
            .select(id_col, "part",
                    F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
                    .alias("messages")))

