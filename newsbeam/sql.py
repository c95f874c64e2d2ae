"""SQL surface: the engine's scalars as SQL functions, the general CSS
selector as a table function, and views over the store.

The scalar functions are SQL-bodied temporary functions: Spark inlines
their bodies into the plan, so they run as native expressions inside
whole-stage codegen exactly like the Column helpers (same fixed values).
``nb_select_css`` is a Python UDTF with Arrow transfer, for ``LATERAL``
use; it is the slow path, like ``extract_css``.

    register_functions(spark)
    spark.sql("SELECT nb_recent(age_text, 'strict30') FROM ...")
    spark.sql("SELECT p.page_id, s.* FROM pages p, LATERAL nb_select_css(p.html, 'nav li a') s")
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from .functions.answers import ANSWER_MARKER, PROMPT_HEAD, PROMPT_TAIL
from .functions.dates import DAY_KEY_FORMAT
from .functions.text import ENTITIES, TAG_RE, WS_CHARS, WS_CLASS
from .operators.sentiment import lexicon_pattern


def _q(s: str) -> str:
    """Raw Spark SQL string literal for a regex (backslashes stay as written)."""
    if "'" in s:
        raise ValueError("pattern holds a quote")
    return f"r'{s}'"


def _lit(s: str) -> str:
    """Plain string literal for text with newlines or quotes."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _strip(e: str) -> str:
    return f"btrim({e}, {_lit(WS_CHARS)})"


def _decode(e: str) -> str:
    for ent, ch in ENTITIES:
        e = f"replace({e}, {_lit(ent)}, {_lit(ch)})"
    return e


def _first_word_int(e: str) -> str:
    s = _strip(e)
    return f"try_cast(CASE WHEN {s} <> '' THEN split({s}, {_q(WS_CLASS + '+')}, 2)[0] END AS INT)"


def _age_minutes(e: str) -> str:
    n = _first_word_int(e)
    return (f"CASE WHEN {e} = 'a few seconds ago' THEN 0 WHEN {e} = 'a minute ago' THEN 1 "
            f"WHEN {e} = 'an hour ago' THEN 60 WHEN endswith({e}, ' minutes ago') THEN {n} "
            f"WHEN endswith({e}, ' hours ago') THEN {n} * 60 END")


FUNCTIONS = {
    "nb_strip": ("x STRING", "STRING", _strip("x")),
    "nb_first_line": ("x STRING", "STRING", "substring_index(x, '\\n', 1)"),
    "nb_element_text": ("x STRING", "STRING", _strip(_decode(f"regexp_replace(x, {_q(TAG_RE)}, '')"))),
    "nb_first_word_int": ("x STRING", "INT", _first_word_int("x")),
    "nb_age_minutes": ("x STRING", "INT", _age_minutes("x")),
    "nb_recent": ("x STRING, mode STRING", "BOOLEAN",
                  "coalesce(CASE mode "
                  "WHEN 'strict30' THEN x = 'an hour ago' "
                  f"OR (contains(x, 'minutes') AND {_first_word_int('x')} <= 30) "
                  "WHEN 'lenient' THEN x = 'an hour ago' OR contains(x, 'minutes') "
                  f"WHEN 'within60' THEN {_age_minutes('x')} <= 60 END, false)"),
    "nb_day_key": ("d DATE", "STRING", f"date_format(d, {_lit(DAY_KEY_FORMAT)})"),
    "nb_same_day": ("x STRING, d DATE", "BOOLEAN",
                    f"coalesce(CAST(try_to_timestamp(x, {_lit(DAY_KEY_FORMAT)}) AS DATE) = d, false)"),
    "nb_render_prompt": ("x STRING", "STRING", f"concat({_lit(PROMPT_HEAD)}, x, {_lit(PROMPT_TAIL)})"),
    "nb_parse_answer": ("x STRING", "STRING", f"try_element_at(split(x, {_q(re.escape(ANSWER_MARKER))}, -1), 2)"),
    "nb_label": ("a STRING", "INT", "CASE WHEN a = 'negative' THEN -1 WHEN a = 'positive' THEN 1 ELSE 0 END"),
    "nb_label_contains": ("a STRING", "INT",
                          "CASE WHEN contains(a, 'negative') THEN -1 WHEN contains(a, 'positive') THEN 1 ELSE 0 END"),
    "nb_lexicon_answer": ("x STRING", "STRING",
                          f"CASE WHEN x RLIKE {_q(lexicon_pattern())} THEN 'negative' ELSE 'neutral' END"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the ``nb_*`` temporary functions and the ``nb_select_css`` UDTF."""
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    spark.udtf.register("nb_select_css", _select_css_udtf())
    return sorted(FUNCTIONS) + ["nb_select_css"]


def _select_css_udtf():
    from pyspark.sql.functions import udtf

    from .operators.extract import parse_selector, select_texts

    @udtf(returnType="pos bigint, text string", useArrow=True)
    class SelectCss:
        def eval(self, html: str, selector: str):
            for i, (_, text) in enumerate(select_texts(html, [("s", parse_selector(selector))])):
                yield i, text

    return SelectCss


def register_views(spark: SparkSession, store_path: str | None = None,
                   snapshots_path: str | None = None, sf_dir: str | None = None,
                   tables=None) -> list[str]:
    """Temp views: ``headlines`` (the store), ``scores_snapshot``, and with
    ``sf_dir`` the fixture view ``h`` and the driver tables (all, or ``tables``)."""
    from .sources import store
    from .sources.fixtures import headlines_view
    from .sources.tables import TABLES, read_table
    names = []
    if store_path:
        store.read_store(spark, store_path).createOrReplaceTempView("headlines")
        names.append("headlines")
    if snapshots_path:
        store.read_snapshots(spark, snapshots_path).createOrReplaceTempView("scores_snapshot")
        names.append("scores_snapshot")
    if sf_dir:
        import os
        for t in (tables if tables is not None else TABLES):
            if os.path.exists(os.path.join(sf_dir, f"{t}.parquet")):
                read_table(spark, sf_dir, t).createOrReplaceTempView(t)
                names.append(t)
        headlines_view(spark, sf_dir).createOrReplaceTempView("h")
        headlines_view(spark, sf_dir, ages=True).createOrReplaceTempView("h_ages")
        names += ["h", "h_ages"]
    return names
