"""Operator 2, URL filters: a sort-merge range join, native.

A rule (host, path prefix) fits its host, all subdomains and every path below the prefix.
Canonical keys are reversed host labels, a separator and the path, so a rule is the
interval of all keys that start with its own key, and intervals are nested or apart. A url
has one key for each suffix of its host that a rule could name. Rules and url keys are
sorted together; the sweep carries the stack of rules open at the last rule seen (each
rule comes with the rules around it) and a url key takes the innermost that still covers
it. The longest rule over a url's keys wins.

Skew: the sweep runs within (first label, salt); url keys are dealt over as many salts as
keep a piece below ``PIECE`` keys whatever the table's size, and the rules are copied to each,
so a hot host is spread. The best rule per url is a maximum with partial aggregation.

Defined results: null urls and urls without ``://`` have an empty host and path and match
nothing; unmatched urls get ``default``. Every input row gives one row, repeated rows and
null ids too. Ties in length go to the longer host. Extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
SEPARATOR = "\x01"
#: Url keys that one window sorts at most, about.
PIECE = 500_000


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every row."""
    cut = pages.select("page_id", "url", F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).alias("rest"))
    cut = cut.withColumn("rest", F.substring_index(F.substring_index("rest", "?", 1), "#", 1))
    host = F.translate(F.substring_index("rest", "/", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.when(F.instr("rest", "/") > 0, F.expr("substring(rest, instr(rest, '/'))"))
    return cut.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def key_of(host: str, path: str) -> Column:
    """Reversed labels, the separator, the path."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(SEPARATOR), F.col(path))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def with_stack(rules: DataFrame) -> DataFrame:
    """Each distinct rule with the array of rules whose interval holds it, itself last:
    the sweep's stack just after it opens. Its key's prefixes are matched by equality."""
    own = (rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
           .withColumn("key", key_of("host", "path")))
    entry = F.struct("key", F.concat("host", "path").alias("rule"), F.length(F.concat("host", "path")).alias("size"),
                     F.length("host").alias("host_size"), "verdict")
    outer = own.select(F.col("key").alias("prefix"), entry.alias("outer"))
    prefixes = own.select("key", F.explode(F.expr("transform(sequence(1, length(key)), i -> substring(key, 1, i))")).alias("prefix"))
    stacks = (prefixes.join(outer, "prefix").groupBy("key")
              .agg(F.sort_array(F.collect_list(F.struct(F.length("outer.key").alias("depth"), "outer"))).alias("s")))
    return stacks.select("key", F.expr("transform(s, x -> x.outer)").alias("stack"))


def judge(pages: DataFrame, rules: DataFrame | None = None, default: str = "allow", salts: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    stacks = with_stack(rules)
    depth = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("d"))
    n_labels = (depth.first()["d"] or 0)  # one number; longer suffixes can't be named by a rule
    if salts is None:
        salts = max(64, -(-pages.count() * max(n_labels, 1) // PIECE))
    urls = split_url(pages).withColumn("row", F.monotonically_increasing_id())
    labels = F.reverse(F.split("host", r"\."))
    probes = (urls.withColumn("labels", F.when(F.col("host") != "", labels))
              .withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
              .select("row", "page_id", "host", "path", "salt",
                      F.posexplode_outer(F.expr(f"slice(labels, 1, {max(n_labels, 1)})")).alias("at", "label"), "labels")
              .select("row", "page_id", "host", "path", "salt",
                      F.expr(f"concat(array_join(slice(labels, 1, at + 1), '.'), '{SEPARATOR}', path)").alias("key")))
    zone = F.substring_index(F.substring_index("key", SEPARATOR, 1), ".", 1)
    opened = stacks.select("key", "stack", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    both = probes.withColumn("kind", F.lit(1)).unionByName(opened.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    sweep = Window.partitionBy("zone", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (both.withColumn("zone", F.coalesce(zone, F.lit("")))
             .withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1"))
    # intervals are laminar: of the open stack, the last rule whose key starts ours is the innermost
    fits = F.expr("element_at(filter(coalesce(open, array()), r -> startswith(key, r.key)), -1)")
    best = (swept.withColumn("fit", F.when(F.size(F.expr("filter(open, r -> startswith(key, r.key))")) > 0, fits))
            .withColumn("rank", F.when(F.col("fit").isNotNull(), F.struct("fit.size", "fit.host_size", "fit.rule", "fit.verdict")))
            .groupBy("row", "page_id", "host", "path").agg(F.max("rank").alias("best")))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
         THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '' END AS path FROM cut),
rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
       (SELECT max_by(rhost || rpath, length(rhost || rpath)) FROM rules
        WHERE (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
       coalesce((SELECT max_by(rverdict, length(rhost || rpath)) FROM rules
        WHERE (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)), 'allow') AS verdict
FROM parts
"""
