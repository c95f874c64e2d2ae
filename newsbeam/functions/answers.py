"""Prompt, answer and label scalars of the sentiment job (native expressions)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MESSAGES

# The instruction format the sentiment model was tuned on, the
# marker that precedes its answer, the three classes, and the system text of
# the chat form.
INSTRUCTION = ("Instruction: What is the sentiment of this news? "
               "Please choose an answer from {negative/neutral/positive}")
INPUT_PREFIX = "Input: "
ANSWER_MARKER = "Answer: "
NEGATIVE, NEUTRAL, POSITIVE = "negative", "neutral", "positive"
SYSTEM_CONTENT = "Hello"

PROMPT_HEAD = INSTRUCTION + "\n" + INPUT_PREFIX
PROMPT_TAIL = ".\n" + ANSWER_MARKER


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_prompt(c) -> Column:
    """Instruction, ``Input: <text>.`` and the answer marker, one per line."""
    return F.concat(F.lit(PROMPT_HEAD), _col(c), F.lit(PROMPT_TAIL))


def render_prompt_py(text: str) -> str:
    """The same prompt built in Python (for scorers running in pandas)."""
    return f"{PROMPT_HEAD}{text}{PROMPT_TAIL}"


def parse_answer(c) -> Column:
    """Second piece after splitting generated text on the marker; null without one."""
    return F.try_element_at(F.split(_col(c), re.escape(ANSWER_MARKER), -1), F.lit(2))


def parse_answer_py(text):
    if text is None:
        return None
    parts = text.split(ANSWER_MARKER)
    return parts[1] if len(parts) > 1 else None


def to_label(c, mode: str = "exact") -> Column:
    """Answer to -1 / 0 / +1.

    ``exact``: the answer equals ``negative`` / ``positive`` (negative first).
    ``contains``: substring test, negative first.
    Anything else, and null, is 0.
    """
    a = _col(c)
    if mode == "exact":
        neg, pos = a == NEGATIVE, a == POSITIVE
    elif mode == "contains":
        neg, pos = a.contains(NEGATIVE), a.contains(POSITIVE)
    else:
        raise ValueError(f"unknown label mode {mode!r}")
    return (F.when(neg, F.lit(-1)).when(pos, F.lit(1)).otherwise(F.lit(0))).cast("int")


def to_messages(c, system: str = SYSTEM_CONTENT) -> Column:
    """Chat form of one prompt: a system message then the user message."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), _col(c).alias("content")),
    ).cast(MESSAGES)
