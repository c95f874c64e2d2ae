"""SpotSigs document fingerprints (operator 8, native).

A spot signature is a run of common words (the anchor) together with the chain
of the next ``CHAIN`` content words behind it; common words inside the chain are
passed over.  The start of the text counts as an anchor, so every text with a
content word has a signature.  The fingerprint is the set of signatures, written
as the first 8 hexadecimal digits of their md5, sorted and joined without a
separator.  Likeness is the Jaccard similarity of two such sets; two empty sets
are alike (1.0).

``near_pairs`` finds all pairs of fingerprints with likeness of at least a
threshold: fingerprints are partitioned by set length (two sets that similar lie
in the same or neighbouring length classes), candidates share one of the rarest
signatures of each set (prefix filter), lengths prune, and the sets decide.  No
query calls it; its candidates grow with the square of the sets that share a rare
signature, so a passage shared by many short documents is too much for it.

Scale: a fingerprint is SQL expressions over one row.  The neighbour of a
document (``edited`` texts) is found on ids alone (``successors``); equal rows are
merged before any text moves, and of the neighbour only the piece that is needed
and its fingerprint move.  No Python, no broadcast hint.

Edge cases: null text is empty; repeated rows (same id and text) follow one
another, so the next document of all but the last of them is their own copy;
null ids come last; one document is its own next document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, successors, table

CHAIN = 3

#: fixed values: frequent function words of the four languages
ANCHORS = {
    "en": "the of and to in is a that for on with was are be as by this it or from an at",
    "fr": "de la le les et des en un une du que qui pour dans est par sur au pas plus ce",
    "de": "der die und in den von zu mit ist das nicht ein eine im sich auf dem für des als",
    "es": "de la que el en y a los se del las un por con no una su para es al lo",
}
ANCHOR_WORDS = sorted({w for line in ANCHORS.values() for w in line.split()})


def signatures(text: Column, chain: int = CHAIN, anchors=None) -> Column:
    """The text's spot signatures as a sorted array of 8-digit strings."""
    words = anchors or ANCHOR_WORDS
    # <w1><w2>..., then anchors lose their brackets: <content>anchors<content>...
    flat = F.concat(F.lit("<"), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "><"), F.lit(">"))
    glued = F.regexp_replace(F.regexp_replace(flat, "<>", ""), "<(" + "|".join(words) + ")>", r" $1")
    parts = F.split(glued, "<")  # part 0: anchors before the first content word

    def of(p):  # a lambda's argument is evaluated once for the text
        def one(e, j):
            nxt = [F.substring_index(F.get(p, j + d), ">", 1) for d in range(1, chain + 1)]
            here = F.when(j == 0, e).otherwise(F.substring_index(e, ">", -1))
            return F.when(((j == 0) | ~e.endswith(">")) & (j < F.size(p) - 1),
                          F.substring(F.md5(F.concat_ws(" ", here, *nxt)), 1, 8))
        return F.array_sort(F.array_distinct(F.array_compact(F.transform(p, one))))
    return F.get(F.transform(F.array(parts), of), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature arrays."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def edited_fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``docs(doc_id, text)`` -> per row doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next."""
    raw = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.md5("text"))
    # one key that is never null, so that grouping and both joins share one shuffle of the texts
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("tie"))
    whole = raw.withColumn("key", key).groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    ids = raw.select("doc_id", "tie", F.length("text").alias("n_chars")).distinct().withColumn("key", key)
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ring = stage(successors(ids, order, ["doc_id", "key", "n_chars"], ["key"]), "ring")
    # the neighbour hands over the piece that its predecessor needs and its own signatures;
    # both sides read the same columns of ``whole`` (hence copies > 0), so its shuffle is made once
    need = ring.select("doc_id", F.col("key").alias("to_key"), F.expr("n_chars div 3").alias("need"), "next_key")
    given = (need.join(whole, F.expr("next_key = key")).where("copies > 0")
             .select("doc_id", "to_key", F.expr("left(text, cast(need as int))").alias("piece"), signatures(F.col("text"), chain).alias("next_sigs")))
    own = whole.join(given, F.expr("key = to_key")).select("doc_id", "text", "copies", "piece", "next_sigs")
    own = own.withColumn("n_chars", F.length("text").cast("long")).withColumn("sigs", signatures(F.col("text"), chain))
    # of several equal rows all but one are followed by their own copy
    turns = F.array(F.struct(F.col("piece").alias("piece"), F.col("next_sigs").alias("next_sigs"), F.lit(1).cast("long").alias("rows")),
                    F.struct(F.expr("left(text, cast(n_chars div 3 as int))").alias("piece"), F.col("sigs").alias("next_sigs"), (F.col("copies") - 1).alias("rows")))
    own = own.select("doc_id", "text", "n_chars", "sigs", F.explode(F.filter(turns, lambda t: t["rows"] > 0)).alias("t"))
    keep = F.expr("left(text, cast(n_chars - n_chars div 3 as int))")
    own = own.select("doc_id", "n_chars", "sigs", F.col("t.next_sigs").alias("next_sigs"), F.col("t.rows").alias("rows"), F.concat(keep, "t.piece").alias("edited"))
    own = own.select("doc_id", "n_chars", "sigs", "next_sigs", "rows", F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("edited"), chain).alias("edited_sigs"))
    out = own.select("doc_id", "n_chars", "edited_sha256", F.array_join("sigs", "").alias("fingerprint"), F.array_join("edited_sigs", "").alias("edited_fingerprint"),
                     likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"), "rows")
    return out.select("*", F.explode(F.expr("sequence(1L, rows)")).alias("__copy")).drop("rows", "__copy")


def near_pairs(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``prints(doc_id, sigs)`` -> pairs ``(a, b, likeness)``, ``a < b``, of class
    representatives (the smallest id of equal fingerprints) with likeness of at
    least ``threshold``; members follow by joining on the fingerprint.  Empty
    fingerprints take no part."""
    reps = (prints.where(F.size("sigs") > 0).groupBy("sigs").agg(F.min("doc_id").alias("doc_id"))
            .select("doc_id", "sigs", F.size("sigs").alias("n")))
    reps = stage(reps, "spot-reps")
    step = -math.log(threshold)
    tokens = reps.select("doc_id", "n", F.explode("sigs").alias("sig"))
    freq = tokens.groupBy("sig").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("df", "sig"))
    # two sets of likeness >= t share one of their n - ceil(t n) + 1 rarest signatures
    rare = (tokens.join(freq, "sig").withColumn("rk", rank)
            .where(F.col("rk") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
            .withColumn("part", F.floor(F.log("n") / step + 1e-9)))
    x = rare.select(F.col("sig"), F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("doc_id").alias("x"), F.col("n").alias("nx"))
    y = rare.select("sig", "part", F.col("doc_id").alias("y"), F.col("n").alias("ny"))
    cand = (x.join(y, ["sig", "part"]).where("x <> y AND nx <= ny").where(F.col("nx") >= F.col("ny") * threshold - 1e-9)
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    sa = reps.select(F.col("doc_id").alias("a"), F.col("sigs").alias("sa"))
    sb = reps.select(F.col("doc_id").alias("b"), F.col("sigs").alias("sb"))
    return (cand.join(sa, "a").join(sb, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
            .where(F.col("likeness") >= threshold))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sigs_sql(text: str) -> str:
    alt = "|".join(ANCHOR_WORDS)
    parts = (f"string_split(regexp_replace(replace('<' || regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', '><', 'g') || '>', '<>', ''), "
             f"'<({alt})>', ' \\1', 'g'), '<')")
    word = "CASE WHEN j + {d} <= len(p) THEN ' ' || string_split(p[j + {d}], '>')[1] ELSE '' END"
    chain = " || ".join(word.format(d=d) for d in range(1, CHAIN + 1))
    here = "(CASE WHEN j = 1 THEN p[1] ELSE string_split(p[j], '>')[-1] END)"
    return (f"(SELECT list_sort(list_distinct(list_transform(list_filter(range(1, len(p)), lambda j: j = 1 OR NOT ends_with(p[j], '>')), "
            f"lambda j: left(md5({here} || {chain}), 8)))) FROM (SELECT {parts} AS p))")


OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT *, length(text) AS n, coalesce(lead(text) OVER w, first_value(text) OVER w) AS nxt
      FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(text) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, substring(text, 1, n - n // 3) || substring(nxt, 1, n // 3) AS edited FROM o),
s AS (SELECT doc_id, n, edited, {_sigs_sql('text')} AS a, {_sigs_sql('edited')} AS b, {_sigs_sql('nxt')} AS c FROM e),
k AS (SELECT *, len(list_intersect(a, b)) AS ab, len(list_intersect(a, c)) AS ac FROM s)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
       CASE WHEN len(a) + len(b) - ab = 0 THEN 1.0::DOUBLE ELSE ab / (len(a) + len(b) - ab) END AS near_edited,
       CASE WHEN len(a) + len(c) - ac = 0 THEN 1.0::DOUBLE ELSE ac / (len(a) + len(c) - ac) END AS near_next
FROM k
"""
