"""URL filter rules as a sort-merge range join (operator 3, native).

A rule is a host and a path prefix (``example.com/en/``) with a verdict; it
fits its host and every subdomain when the url's path starts with the rule's
path, and the longest fitting rule wins.

Hosts are turned round label by label and every label is closed with ``/``
(``www.example.com`` -> ``com/example/www/``), a character no host contains.
A rule's host and its subdomains are then exactly the interval from its key up
to the key with the last ``/`` raised to ``0``, and two intervals are nested or
apart, never crossing.  Hosts and interval ends are sorted together and swept
once: a running last value per nesting level is the stack of open rules, cut at
the current depth.  The path prefix is tested on that stack only.

Scale: the sweep runs over distinct hosts (a hot host is one row after the
map-side step), split by the first two labels and by ``SALTS`` hash shares;
rules are copied to the shares of their own domain, rules on a single label to
those of each domain seen below them.  The answer joins the pages by host, where
adaptive execution splits a hot host.  No Python, no broadcast hint.

Edge cases: a null url or one without ``://`` has empty host and path and no
rule; an empty host fits no rule; rules may repeat (the longest, then the
smallest by host, path and verdict wins); the input may be empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

SALTS = 16

#: the rules the query applies: (host, path, verdict)
QUERY_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
               ("net", "/es/", "block"), ("net", "/fr/", "block")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Path: what follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.com`` -> ``com/example/www/``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))


def _domain(key: Column) -> Column:
    return F.substring_index(key, "/", 2)


def rules_frame(spark: SparkSession, rules=QUERY_RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def match_hosts(hosts: DataFrame, rules: DataFrame, salts: int = SALTS) -> DataFrame:
    """``hosts(host)``, distinct -> ``(host, rules)``: the rules open at each host,
    outermost first, as structs ``(path, rule, verdict, length)``."""
    points = (hosts.where("host <> ''").select(host_key(F.col("host")).alias("k"), "host")
              .withColumn("domain", _domain(F.col("k")))
              .withColumn("salt", F.pmod(F.xxhash64("host"), F.lit(salts)).cast("int")))
    node = F.struct(F.col("path"), F.concat("host", "path").alias("rule"), "verdict",
                    F.length(F.concat("host", "path")).alias("length"))
    nodes = (rules.where("host <> ''").withColumn("k", host_key(F.col("host")))
             .groupBy("k").agg(F.sort_array(F.collect_set(node)).alias("rules"))
             .withColumn("labels", F.size(F.split("k", "/")) - 1))
    shares = points.select("domain", "salt").distinct()
    # a rule of two labels or more lies within one domain; a shorter one covers every domain below its label
    deep = nodes.where("labels >= 2").withColumn("domain", _domain(F.col("k"))).join(shares, "domain")
    top = nodes.where("labels = 1").join(shares, F.substring_index("domain", "/", 1) == F.regexp_replace("k", "/$", ""))
    placed = deep.select("k", "rules", "domain", "salt").unionByName(top.select("k", "rules", "domain", "salt"))
    none = F.lit(None)
    opened = placed.select("domain", "salt", "k", F.lit(1).alias("kind"), F.lit(1).alias("step"), "rules", none.cast("string").alias("host"))
    closed = placed.select("domain", "salt", F.concat(F.expr("substring(k, 1, length(k) - 1)"), F.lit("0")).alias("k"),
                           F.lit(0).alias("kind"), F.lit(-1).alias("step"), none.cast("array<struct<path:string,rule:string,verdict:string,length:int>>").alias("rules"), none.cast("string").alias("host"))
    asked = points.select("domain", "salt", "k", F.lit(2).alias("kind"), F.lit(0).alias("step"),
                          none.cast("array<struct<path:string,rule:string,verdict:string,length:int>>").alias("rules"), "host")
    sweep = Window.partitionBy("domain", "salt").orderBy("k", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    events = opened.unionByName(closed).unionByName(asked).withColumn("depth", F.sum("step").over(sweep))
    # nesting is at most the number of labels of the deepest rule: one small aggregate of the rules
    levels = nodes.agg(F.max("labels")).first()[0] or 0
    if not levels:
        return asked.select("host", F.array().cast("array<struct<path:string,rule:string,verdict:string,length:int>>").alias("rules"))
    stack = F.array(*[F.last(F.when((F.col("depth") == d) & (F.col("step") == 1), F.col("rules")), ignorenulls=True).over(sweep)
                      for d in range(1, levels + 1)])
    return (events.withColumn("stack", stack).where("kind = 2")
            .select("host", F.flatten(F.slice("stack", F.lit(1), F.col("depth").cast("int"))).alias("rules")))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row of ``pages``; ``default``
    is the verdict where no rule fits."""
    urls = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    found = match_hosts(urls.select("host").distinct(), rules)
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["path"]))
    best = F.get(F.sort_array(F.transform(fits, lambda r: F.struct((-r["length"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict")))), F.lit(0))
    return (urls.join(found, "host", "left").withColumn("best", best)
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rules_frame(spark))


OP3_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(h, p, v) AS (VALUES ('com','/','allow'), ('example.com','/en/','block'), ('www.example.com','/en/','allow'),
                      ('net','/es/','block'), ('net','/fr/','block')),
m AS (SELECT u.page_id, u.host, u.path, h || p AS rule, v,
             row_number() OVER (PARTITION BY u.page_id, u.host, u.path ORDER BY length(h || p) DESC, h || p, v) AS k
      FROM u JOIN r ON (u.host = h OR suffix(u.host, '.' || h)) AND starts_with(u.path, p))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM m WHERE k = 1) m
  ON m.page_id = u.page_id AND m.host = u.host AND m.path = u.path
"""
