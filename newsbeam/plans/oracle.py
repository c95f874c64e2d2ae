"""DuckDB oracle SQL for every query key (tables are pre-registered views).

The view H and the element-text expression are built from the same fixed
values the Spark side uses (white-space class, entity list, prompt parts,
lexicon), so the two engines are held to one definition.
"""

from __future__ import annotations

from ..functions.answers import ANSWER_MARKER, INPUT_PREFIX, INSTRUCTION, SYSTEM_CONTENT
from ..functions.text import ENTITIES, WS_CLASS
from ..operators.lookup import FEED_A_BASE, FEED_B_BASE
from ..operators.sentiment import lexicon_pattern
from .keys import (CONV_PART_TURNS, DIM_REGIONS, DROPPED_SOURCE, EMPTY_SOURCE, FIRST_DAY, NEST_PART_SIZE, NULL_SOURCE,
                   SCALAR_SYMBOL, SEED_SOURCES)

AS_OF_TEXT = "2024-01-02 12:00:00"
DAY = "DATE '2024-01-02'"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q(f'^{WS_CLASS}+|{WS_CLASS}+$')}, '', 'g')"


def element_text(e: str) -> str:
    s = f"regexp_replace({e}, '<[^>]*>', '', 'g')"
    for ent, ch in ENTITIES:
        s = f"replace({s}, {q(ent)}, {q(ch)})"
    return strip(s)


def first_word_int(e: str) -> str:
    return f"TRY_CAST(string_split_regex({strip(e)}, {q(WS_CLASS + '+')})[1] AS INTEGER)"


def strict30(e: str) -> str:
    return (f"coalesce({e} = 'an hour ago' OR (contains({e}, 'minutes') AND "
            f"{first_word_int(e)} <= 30), false)")


def within_minutes(e: str, n: int) -> str:
    fw = first_word_int(e)
    age = (f"CASE WHEN {e} = 'a few seconds ago' THEN 0 WHEN {e} = 'a minute ago' THEN 1 "
           f"WHEN {e} = 'an hour ago' THEN 60 WHEN ends_with({e}, ' minutes ago') THEN {fw} "
           f"WHEN ends_with({e}, ' hours ago') THEN {fw} * 60 END")
    return f"coalesce(({age}) <= {n}, false)"


def lenient(e: str) -> str:
    return f"coalesce({e} = 'an hour ago' OR contains({e}, 'minutes'), false)"


HOST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1)"

H = f"""
h0 AS (
  SELECT e.event_id AS doc_id, d.doc_id AS src_id,
         CASE WHEN (e.event_id // 20) % 2 = 0 THEN 'A' ELSE 'B' END AS feed,
         d.source AS symbol,
         {strip("d.text")} AS headline,
         e.ts AS seen_at,
         CAST(e.ts AS DATE) AS day
  FROM documents d JOIN events e ON d.doc_id = (e.event_id // 3) % (SELECT max(doc_id) + 1 FROM documents)),
hl AS (SELECT day, max(seen_at) AS latest FROM h0 GROUP BY day),
h1 AS (
  SELECT h0.*, strftime(h0.seen_at, '%b %d, %Y') AS day_text,
         (epoch_us(hl.latest) - epoch_us(h0.seen_at)) // 60000000 AS age_min
  FROM h0 JOIN hl ON h0.day = hl.day),
H AS (
  SELECT *, CASE WHEN age_min = 0 THEN 'a few seconds ago'
                 WHEN age_min = 1 THEN 'a minute ago'
                 WHEN age_min < 60 THEN CAST(age_min AS VARCHAR) || ' minutes ago'
                 WHEN age_min < 120 THEN 'an hour ago'
                 ELSE CAST(age_min // 60 AS VARCHAR) || ' hours ago' END AS age_text
  FROM h1),
A AS (SELECT * FROM H WHERE feed = 'A'),
B AS (SELECT * FROM H WHERE feed = 'B'),
BF AS (SELECT * FROM (SELECT B.*, row_number() OVER (PARTITION BY day, symbol, headline ORDER BY doc_id) AS rn
                      FROM B) WHERE rn = 1),
NOVEL AS (SELECT * FROM BF WHERE NOT EXISTS (
            SELECT 1 FROM A WHERE A.day = BF.day AND A.symbol = BF.symbol AND A.headline = BF.headline)),
ANS AS (SELECT e.event_id AS doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
                                         ELSE 'neutral' END AS answer
        FROM labels l JOIN events e ON l.doc_id = (e.event_id // 3) % (SELECT max(doc_id) + 1 FROM documents)),
LAB AS (SELECT H.*, ANS.answer,
               CAST(CASE WHEN ANS.answer = 'negative' THEN -1 WHEN ANS.answer = 'positive' THEN 1 ELSE 0 END
                    AS INTEGER) AS label
        FROM H LEFT JOIN ANS ON H.doc_id = ANS.doc_id),
SCORES AS (SELECT day, symbol, CAST(sum(label) AS BIGINT) AS score FROM LAB GROUP BY day, symbol),
RANKED AS (SELECT day, symbol, score,
                  CAST(row_number() OVER (PARTITION BY day ORDER BY score DESC, symbol) AS INTEGER) AS rank
           FROM SCORES)
"""


def with_h(body: str) -> str:
    return f"WITH {H}\n{body}"


NATION_DIM = ("SELECT n.n_nationkey AS ord, n.n_name AS symbol, r.r_name AS slug "
              "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")


def _extract_all(pattern: str, src: str = "html") -> str:
    return f"regexp_extract_all({src}, {q(pattern)}, 1)"


def _exploded(list_sql: str, extra: str = "", names: str = "", src_from: str = "pages") -> str:
    """Rows ``(page_id, names..., i, el)`` for every element of a list, 1-based ``i``."""
    return (f"SELECT page_id{names}, i, els[i] AS el FROM "
            f"(SELECT page_id{extra}, {list_sql} AS els FROM {src_from}) x, "
            f"LATERAL (SELECT unnest(range(1, len(x.els) + 1)) AS i) r")


H1 = r"(?s)<h1(?:\s[^>]*)?>(.*?)</h1\s*>"
LI = r"(?s)<li(?:\s[^>]*)?>(.*?)</li\s*>"
HREF = r'(?s)\shref="([^"]*)"'
AD = r'(?s)<div\s[^>]*class="ad"[^>]*>(.*?)</div\s*>'
NAV = r"(?s)<nav(?:\s[^>]*)?>(.*?)</nav\s*>"
A_TAG = r"(?s)<a(?:\s[^>]*)?>(.*?)</a\s*>"

CSS_CTES = f"""
ad AS ({_exploded(_extract_all(AD))}),
ads AS (SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, {element_text("el")} AS text FROM ad),
nav AS (SELECT page_id, {_extract_all(NAV)} AS navs FROM pages),
navi AS (SELECT page_id, j, navs[j] AS nav_html FROM nav,
         LATERAL (SELECT unnest(range(1, len(nav.navs) + 1)) AS j) r),
link AS (SELECT page_id, j, i, els[i] AS el FROM
           (SELECT page_id, j, {_extract_all(A_TAG, "nav_html")} AS els FROM navi) x,
           LATERAL (SELECT unnest(range(1, len(x.els) + 1)) AS i) r),
links AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY j, i) - 1 AS BIGINT) AS pos,
                 {element_text("el")} AS text FROM link)"""

PROMPT_SQL = (f"{q(INSTRUCTION)} || chr(10) || {q(INPUT_PREFIX)} || headline || '.' || chr(10) || "
              f"{q(ANSWER_MARKER)}")


def _label_sql(mode: str) -> str:
    test = ("answer = 'negative'", "answer = 'positive'") if mode == "exact" else \
        ("contains(answer, 'negative')", "contains(answer, 'positive')")
    return f"""
SELECT doc_id, answer,
       CAST(CASE WHEN {test[0]} THEN -1 WHEN {test[1]} THEN 1 ELSE 0 END AS INTEGER) AS label
FROM (SELECT doc_id,
             CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END
             || CASE WHEN doc_id % 5 = 0 THEN '.' ELSE '' END AS answer
      FROM labels) t"""


LEXICON = f"""
SELECT doc_id, CASE WHEN regexp_matches(text, {q(lexicon_pattern())}) THEN 'negative' ELSE 'neutral' END AS answer
FROM documents"""


ORACLE = {
    "read_day": with_h(f"""
SELECT doc_id, feed, symbol, headline, CAST(day AS VARCHAR) AS day, day_text, age_text
FROM H WHERE day = {DAY}"""),

    "seed_urls_slug": f"SELECT ord, symbol, {q(FEED_A_BASE)} || slug AS url FROM ({NATION_DIM}) d",
    "seed_urls_slug_news": f"SELECT ord, symbol, {q(FEED_A_BASE)} || slug || '/news' AS url FROM ({NATION_DIM}) d",
    "seed_urls_search": (f"SELECT n_nationkey AS ord, n_name AS symbol, "
                         f"{q(FEED_B_BASE + '?s=')} || n_name || '&sort=1' AS url FROM nation"),
    "unknown_symbols": f"""
SELECT n_nationkey AS ord, n_name AS symbol, 'unknown_symbol' AS reason FROM nation
WHERE n_name NOT IN (SELECT symbol FROM ({NATION_DIM}) d
                     WHERE slug IN ({", ".join(q(r) for r in DIM_REGIONS)}))""",

    "read_raw_pages": """
WITH p AS (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN replace(html, 'charset="utf-8"', 'charset="windows-1252"') ELSE html END AS html FROM pages)
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'A' ELSE 'B' END AS feed, string_split(url, '/')[3] AS symbol,
       CASE WHEN page_id % 2 = 0 THEN 'windows-1252' ELSE 'utf-8' END AS charset, CAST(length(html) AS BIGINT) AS n_chars, md5(html) AS html_md5
FROM p""",
    "extract_titles": f"""
SELECT page_id, symbol, CAST(i - 1 AS BIGINT) AS pos, {element_text("el")} AS title
FROM ({_exploded(_extract_all(H1), f", {HOST} AS symbol", ", symbol")}) t""",

    "extract_zip": f"""
WITH z AS (SELECT page_id, {HOST} AS symbol, {_extract_all(LI)} AS hs, {_extract_all(HREF)} AS ds FROM pages)
SELECT page_id, symbol, 'A' AS feed, CAST(i - 1 AS BIGINT) AS pos, ds[i] AS date_text,
       {element_text("hs[i]")} AS headline
FROM z, LATERAL (SELECT unnest(range(1, len(z.hs) + 1)) AS i) r""",

    "extract_css": f"""
WITH {CSS_CTES}
SELECT page_id, 'ad' AS selector, pos, text FROM ads
UNION ALL
SELECT page_id, 'nav_link' AS selector, pos, text FROM links""",
    "extract_headlines_css": f"""
WITH {CSS_CTES}
SELECT l.page_id, p.symbol, 'A' AS feed, l.pos, ads.text AS date_text, l.text AS headline
FROM links l LEFT JOIN ads ON l.page_id = ads.page_id AND l.pos = ads.pos
JOIN (SELECT page_id, {HOST} AS symbol FROM pages) p ON l.page_id = p.page_id""",

    "recent_strict30": with_h(f"""
SELECT doc_id, symbol, CAST(day AS VARCHAR) AS day, age_text FROM H WHERE {strict30("age_text")}"""),
    "recent_lenient": with_h(f"""
SELECT doc_id, symbol, CAST(day AS VARCHAR) AS day, age_text FROM H WHERE {lenient("age_text")}"""),
    "recent_within60": with_h(f"""
SELECT doc_id, symbol, CAST(day AS VARCHAR) AS day, age_text FROM H WHERE {within_minutes("age_text", 60)}"""),
    "same_day": with_h("SELECT doc_id, symbol, day_text FROM H WHERE day_text = 'Jan 02, 2024'"),
    "same_day_text": with_h("SELECT doc_id, symbol, day_text FROM H WHERE day_text = 'Jan 02, 2024'"),
    "quarantine_ages": with_h(f"""
, M AS (SELECT doc_id, age_text FROM H WHERE contains(age_text, 'minutes')),
V AS (SELECT doc_id, 'orig' AS variant, age_text FROM M
      UNION ALL SELECT doc_id, 'few' AS variant, regexp_replace(age_text, '^\\S+', 'few') AS age_text FROM M)
SELECT doc_id, variant, age_text,
       CASE WHEN contains(age_text, 'minutes') AND age_text <> 'an hour ago'
                 AND {first_word_int("age_text")} IS NULL THEN 'quarantine'
            WHEN {strict30("age_text")} THEN 'pass' ELSE 'fail' END AS outcome
FROM V"""),
    "nonempty_symbols": with_h(f"SELECT DISTINCT symbol FROM H WHERE {strict30('age_text')}"),

    "novel_headlines": with_h("SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, headline FROM NOVEL"),
    "merge_day": with_h("""
SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, feed, headline, false AS processed,
       CAST(NULL AS VARCHAR) AS labelled FROM A
UNION ALL
SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, feed, headline, false AS processed,
       CAST(NULL AS VARCHAR) AS labelled FROM NOVEL"""),
    "merge_day_keep_all": with_h(f"""
, A1 AS (SELECT * FROM A WHERE day = DATE '{FIRST_DAY}')
SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, feed, headline FROM A1
UNION ALL
SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, feed, headline FROM B WHERE day <> DATE '{FIRST_DAY}'
UNION ALL
SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, feed, headline FROM BF
WHERE day = DATE '{FIRST_DAY}' AND NOT EXISTS (
  SELECT 1 FROM A1 WHERE A1.day = BF.day AND A1.symbol = BF.symbol AND A1.headline = BF.headline)"""),
    "combine_feeds": with_h("""
SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, feed, headline FROM (
  SELECT H.*, row_number() OVER (PARTITION BY day, symbol, headline ORDER BY doc_id, feed) AS rn FROM H) t
WHERE rn = 1"""),
    "write_day_roundtrip": with_h(f"""
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, doc_id AS pos, headline, false AS processed FROM A
UNION ALL
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, doc_id AS pos, headline, false AS processed
FROM NOVEL WHERE day = {DAY}"""),
    "merge_symbol_maps": with_h("""
, U AS (SELECT day, symbol, headline, 1 AS s, 0 AS a FROM A
        UNION ALL
        SELECT day, symbol, headline, 0 AS s,
               CASE WHEN doc_id IN (SELECT doc_id FROM NOVEL) THEN 1 ELSE 0 END AS a FROM BF)
SELECT CAST(day AS VARCHAR) AS day, symbol,
       CAST(sum(s) AS BIGINT) AS n_stored, CAST(sum(a) AS BIGINT) AS n_added,
       CAST(sum(s + a) AS BIGINT) AS n_total,
       min(CASE WHEN s + a > 0 THEN headline END) AS min_headline,
       max(CASE WHEN s + a > 0 THEN headline END) AS max_headline
FROM U GROUP BY day, symbol"""),
    "nest_day": with_h(f"""
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, CAST(doc_id // {NEST_PART_SIZE} AS BIGINT) AS part,
       CAST(count(*) AS BIGINT) AS n_records,
       arg_min(headline, doc_id) AS first_headline, arg_max(headline, doc_id) AS last_headline
FROM H GROUP BY day, symbol, feed, doc_id // {NEST_PART_SIZE}"""),
    "unnest_day": with_h("SELECT CAST(day AS VARCHAR) AS day, symbol, doc_id AS pos, headline FROM H"),
    "day_documents": with_h(f"""
SELECT CAST(day AS VARCHAR) AS day, feed, CAST(doc_id // {NEST_PART_SIZE} AS BIGINT) AS part,
       CAST(count(DISTINCT symbol) AS BIGINT) AS n_symbols, CAST(count(*) AS BIGINT) AS n_records
FROM H GROUP BY day, feed, doc_id // {NEST_PART_SIZE}"""),
    "align_records": with_h("""
SELECT doc_id AS pos, feed, headline, false AS processed, CAST(NULL AS VARCHAR) AS labelled FROM H"""),

    "render_prompt": with_h(f"SELECT doc_id, {PROMPT_SQL} AS prompt FROM H"),
    "parse_answer": with_h(f"""
SELECT doc_id, string_split({PROMPT_SQL} || answer, {q(ANSWER_MARKER)})[2] AS answer FROM LAB"""),
    "label_exact": _label_sql("exact"),
    "label_contains": _label_sql("contains"),
    "score_lexicon": LEXICON,
    "score_map_in_pandas": LEXICON,
    "raw_answers": with_h("SELECT CAST(day AS VARCHAR) AS day, symbol, headline, answer FROM LAB"),
    "to_messages": f"""
SELECT conv_id, turn, CAST(2 AS INTEGER) AS n_messages,
       concat_ws(chr(10), {q('system: ' + SYSTEM_CONTENT)}, 'user: ' || text) AS chat
FROM conversations""",
    "conversation_messages": f"""
SELECT conv_id, CAST(turn // {CONV_PART_TURNS} AS BIGINT) AS part, CAST(count(*) AS BIGINT) AS n_messages,
       string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat
FROM conversations GROUP BY conv_id, turn // {CONV_PART_TURNS}""",
    "apply_labels_all": with_h("""
SELECT doc_id, CAST(day AS VARCHAR) AS day, symbol, headline, true AS processed,
       CAST(label AS VARCHAR) AS labelled FROM LAB"""),
    "apply_labels_first": with_h("""
, K AS (SELECT day, symbol, headline, min(doc_id) AS first_id, arg_max(label, doc_id) AS last_label
        FROM LAB GROUP BY day, symbol, headline)
SELECT LAB.doc_id, CAST(LAB.day AS VARCHAR) AS day, LAB.symbol, LAB.headline,
       coalesce(LAB.doc_id = K.first_id, false) AS processed,
       CAST(CASE WHEN LAB.doc_id = K.first_id THEN K.last_label END AS VARCHAR) AS labelled
FROM LAB LEFT JOIN K ON LAB.day = K.day AND LAB.symbol = K.symbol
                    AND LAB.headline IS NOT DISTINCT FROM K.headline"""),
    "net_score": with_h("SELECT CAST(day AS VARCHAR) AS day, symbol, score FROM SCORES"),
    "net_score_unprocessed": with_h("""
SELECT CAST(u.day AS VARCHAR) AS day, u.symbol, coalesce(s.score, CAST(0 AS BIGINT)) AS score
FROM (SELECT DISTINCT day, symbol FROM H) u
LEFT JOIN (SELECT day, symbol, CAST(sum(label) AS BIGINT) AS score FROM LAB WHERE feed = 'B'
           GROUP BY day, symbol) s ON u.day = s.day AND u.symbol = s.symbol"""),
    "rank_scores": with_h("SELECT CAST(day AS VARCHAR) AS day, rank, symbol, score FROM RANKED"),
    "sql_rank_scores": with_h("SELECT CAST(day AS VARCHAR) AS day, rank, symbol, score FROM RANKED"),
    "snapshot": with_h(f"""
SELECT {q(AS_OF_TEXT)} AS created, CAST(day AS VARCHAR) AS day, rank, symbol, score FROM RANKED"""),
    "snapshot_map": with_h(f"""
SELECT {q(AS_OF_TEXT)} AS created, CAST(day AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS n_symbols,
       '{{' || string_agg('"' || symbol || '":' || CAST(score AS VARCHAR), ',' ORDER BY rank) || '}}' AS sentiments
FROM RANKED GROUP BY day"""),
    "write_labels_roundtrip": with_h("""
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, doc_id AS pos, headline, true AS processed,
       CAST(label AS VARCHAR) AS labelled
FROM LAB"""),
    "stream_dedupe": with_h("SELECT DISTINCT CAST(day AS VARCHAR) AS day, symbol, headline FROM H"),
    "stream_dedupe_store": with_h("SELECT DISTINCT CAST(day AS VARCHAR) AS day, symbol, headline FROM H"),
    "stream_drop_late": with_h(f"""
SELECT doc_id, symbol, CAST(day AS VARCHAR) AS day, age_text FROM H WHERE {strict30("age_text")}"""),
    "stream_cycle": with_h("""
, F AS (SELECT * FROM (SELECT LAB.*, row_number() OVER (PARTITION BY day, symbol, headline ORDER BY doc_id) AS rn
                       FROM LAB) t WHERE rn = 1),
FS AS (SELECT day, symbol, CAST(sum(label) AS BIGINT) AS score FROM F GROUP BY day, symbol)
SELECT (SELECT strftime(max(seen_at), '%Y-%m-%d %H:%M:%S') FROM H) AS created, CAST(day AS VARCHAR) AS day,
       CAST(row_number() OVER (PARTITION BY day ORDER BY score DESC, symbol) AS INTEGER) AS rank, symbol, score
FROM FS"""),
    "stream_daily_scores": with_h("SELECT CAST(day AS VARCHAR) AS day, symbol, score FROM SCORES"),
    "stream_cycle_runs": with_h("""
, FA AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY day, symbol, headline ORDER BY doc_id) AS rn
                             FROM A) t WHERE rn = 1),
RS AS (SELECT 'A' AS run, day, symbol, CAST(sum(label) AS BIGINT) AS score FROM LAB
       WHERE doc_id IN (SELECT doc_id FROM FA) GROUP BY day, symbol
       UNION ALL
       SELECT 'B' AS run, day, symbol, CAST(sum(label) AS BIGINT) AS score FROM LAB
       WHERE doc_id IN (SELECT doc_id FROM FA UNION ALL SELECT doc_id FROM NOVEL)
         AND day IN (SELECT day FROM B) GROUP BY day, symbol),
C AS (SELECT feed AS run, strftime(max(seen_at), '%Y-%m-%d %H:%M:%S') AS created FROM H GROUP BY feed)
SELECT C.created, CAST(RS.day AS VARCHAR) AS day,
       CAST(row_number() OVER (PARTITION BY RS.run, RS.day ORDER BY RS.score DESC, RS.symbol) AS INTEGER) AS rank,
       RS.symbol, RS.score
FROM RS JOIN C ON RS.run = C.run"""),
    "merge_symbol_rows": with_h("""
SELECT CAST(day AS VARCHAR) AS day, symbol, headline, 'stored' AS origin FROM A
UNION ALL
SELECT CAST(day AS VARCHAR) AS day, symbol, headline, 'added' AS origin FROM NOVEL
UNION ALL
SELECT CAST(day AS VARCHAR) AS day, symbol, CAST(NULL AS VARCHAR) AS headline, CAST(NULL AS VARCHAR) AS origin
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS symbol FROM events) u
WHERE NOT EXISTS (SELECT 1 FROM H WHERE H.day = u.day AND H.symbol = u.symbol)"""),
    "write_empty_batch": with_h("""
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, doc_id AS pos, headline, false AS processed FROM A"""),
    "nest_day_records": with_h(f"""
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, CAST(doc_id // {NEST_PART_SIZE} AS BIGINT) AS part,
       string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS positions,
       coalesce(string_agg(headline, chr(10) ORDER BY doc_id), '') AS headlines
FROM H GROUP BY day, symbol, feed, doc_id // {NEST_PART_SIZE}"""),
    "day_document_scalars": with_h(f"""
SELECT CAST(day AS VARCHAR) AS day, feed, CAST(doc_id // {NEST_PART_SIZE} AS BIGINT) AS part,
       bool_or(symbol = {q(SCALAR_SYMBOL)}) AS has_symbol,
       bool_or(symbol = {q(SCALAR_SYMBOL)} AND doc_id % {NEST_PART_SIZE} = 7) AS holds_seventh,
       coalesce(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FILTER (symbol = {q(SCALAR_SYMBOL)}) || ',', '')
       || '-1' AS positions
FROM H GROUP BY day, feed, doc_id // {NEST_PART_SIZE}"""),
    "conversation_turns": "SELECT conv_id, turn, role, text AS content FROM conversations",
    "read_prompts": f"""
SELECT md5(prompt) AS prompt_md5,
       CASE WHEN prompt IS NULL THEN NULL WHEN regexp_matches(prompt, {q(lexicon_pattern())}) THEN 'negative'
            ELSE 'neutral' END AS answer
FROM (SELECT {PROMPT_SQL} AS prompt FROM (SELECT text AS headline FROM documents) d) p""",
    "stream_dedupe_state": with_h("SELECT DISTINCT CAST(day AS VARCHAR) AS day, symbol, headline FROM H"),
    "score_deltas": with_h(f"""
, LEX AS (SELECT H.*, CAST(CASE WHEN regexp_matches(headline, {q(lexicon_pattern())}) THEN -1 ELSE 0 END AS INTEGER) AS lex FROM H),
LA AS (SELECT day, symbol, headline, max(label) AS label FROM LAB WHERE feed = 'A' GROUP BY day, symbol, headline),
LB AS (SELECT day, symbol, headline, max(label) AS label FROM LAB WHERE feed = 'B' GROUP BY day, symbol, headline),
L2 AS (SELECT day, symbol, headline, label FROM LB UNION ALL
       SELECT day, symbol, headline, label FROM LA
       WHERE NOT EXISTS (SELECT 1 FROM LB WHERE LB.day = LA.day AND LB.symbol = LA.symbol AND LB.headline = LA.headline)),
L3 AS (SELECT day, symbol, headline, max(lex) AS label FROM LEX GROUP BY day, symbol, headline),
ALL3 AS (SELECT 0 AS landing, day, symbol, label FROM LA UNION ALL SELECT 1 AS landing, day, symbol, label FROM L2
         UNION ALL SELECT 2 AS landing, day, symbol, label FROM L3)
SELECT CAST(landing AS INTEGER) AS landing, CAST(day AS VARCHAR) AS day, symbol, CAST(sum(label) AS BIGINT) AS score,
       CAST(count(*) AS BIGINT) AS headlines
FROM ALL3 GROUP BY landing, day, symbol"""),
    "score_memo": with_h(f"""
SELECT doc_id, CASE WHEN headline IS NULL THEN NULL WHEN regexp_matches(headline, {q(lexicon_pattern())}) THEN 'negative'
                    ELSE 'neutral' END AS answer,
       (SELECT CAST(count(DISTINCT headline) AS BIGINT) FROM H) AS asked_first, CAST(0 AS BIGINT) AS asked_again
FROM H"""),
    "score_budgeted": LEXICON,
    "write_buckets_roundtrip": with_h("""
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, doc_id AS pos, headline, true AS processed, CAST(label AS VARCHAR) AS labelled
FROM LAB WHERE feed = 'A' OR doc_id IN (SELECT doc_id FROM NOVEL)"""),
    "day_variant": with_h("""
SELECT CAST(day AS VARCHAR) AS day, symbol, feed, doc_id AS pos, headline, feed = 'B' AS processed,
       CASE WHEN feed = 'B' THEN CAST(label AS VARCHAR) END AS labelled
FROM LAB"""),
    "net_score_null_symbols": with_h(f"""
, ODD AS (SELECT day, CASE WHEN symbol = '{NULL_SOURCE}' THEN NULL WHEN symbol = '{EMPTY_SOURCE}' THEN '' ELSE symbol END AS symbol, label
          FROM LAB),
S AS (SELECT day, symbol, CAST(sum(label) AS BIGINT) AS score FROM ODD GROUP BY day, symbol)
SELECT CAST(day AS VARCHAR) AS day,
       CAST(row_number() OVER (PARTITION BY day ORDER BY score DESC, symbol ASC NULLS FIRST) AS INTEGER) AS rank,
       coalesce(symbol, '(none)') AS symbol, score
FROM S"""),
    "merge_symbol_maps_null_symbols": with_h(f"""
, U AS (SELECT day, symbol, 1 AS s, 0 AS a FROM A
        UNION ALL
        SELECT day, symbol, 0 AS s, CASE WHEN doc_id IN (SELECT doc_id FROM NOVEL) THEN 1 ELSE 0 END AS a FROM BF)
SELECT CAST(day AS VARCHAR) AS day,
       CASE WHEN symbol = '{NULL_SOURCE}' THEN '(none)' WHEN symbol = '{EMPTY_SOURCE}' THEN '' ELSE symbol END AS symbol,
       CAST(sum(s) AS BIGINT) AS n_stored, CAST(sum(a) AS BIGINT) AS n_added, CAST(sum(s + a) AS BIGINT) AS n_total
FROM U GROUP BY ALL"""),
    "nonempty_null_symbols": with_h(f"""
SELECT DISTINCT CASE WHEN symbol = '{NULL_SOURCE}' THEN '(none)' WHEN symbol = '{EMPTY_SOURCE}' THEN '' ELSE symbol END AS symbol
FROM H WHERE {strict30('age_text')} AND symbol <> '{DROPPED_SOURCE}'"""),
    "symbol_headlines": with_h(f"""
, SEED AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{x}', 'source-{x[3:]}')" for i, x in enumerate(SEED_SOURCES))}) t(ord, symbol, slug))
SELECT CAST(SEED.ord AS INTEGER) AS ord, SEED.symbol, SEED.slug, CAST(count(H.doc_id) AS BIGINT) AS n
FROM SEED LEFT JOIN H ON H.symbol = SEED.symbol GROUP BY SEED.ord, SEED.symbol, SEED.slug
UNION ALL SELECT CAST({len(SEED_SOURCES)} AS INTEGER), 'unlisted', '(unknown)', CAST(0 AS BIGINT)"""),
    "job_run": f"""
WITH p AS (SELECT page_id, url, string_split(url, '/')[3] AS symbol, page_id % 2 = 0 AS own,
                  {_extract_all(H1)} AS els FROM pages),
it AS (SELECT symbol, own, page_id, {element_text("els[1]")} AS headline FROM p WHERE len(els) > 0),
kept AS (SELECT * FROM it WHERE (own AND page_id % 60 <= 30) OR (NOT own AND page_id % 4 = 1)),
st AS (SELECT DISTINCT symbol, headline, own FROM kept),
seen AS (SELECT DISTINCT symbol, own FROM it),
runs AS (SELECT 0 AS run UNION ALL SELECT 1 AS run),
rows AS (SELECT DISTINCT run, symbol, headline FROM st, runs WHERE own OR run = 1),
univ AS (SELECT DISTINCT run, symbol FROM seen, runs WHERE own OR run = 1),
sc AS (SELECT u.run, u.symbol,
              CAST(coalesce(sum(CASE WHEN regexp_matches(r.headline, {q(lexicon_pattern())}) THEN -1 ELSE 0 END), 0) AS BIGINT) AS score
       FROM univ u LEFT JOIN rows r ON r.run = u.run AND r.symbol = u.symbol GROUP BY u.run, u.symbol)
SELECT CASE WHEN run = 0 THEN '2024-01-02 10:00:00' ELSE '2024-01-02 11:00:00' END AS created, '2024-01-02' AS day,
       CAST(row_number() OVER (PARTITION BY run ORDER BY score DESC, symbol) AS INTEGER) AS rank, symbol, score
FROM sc""",
}
