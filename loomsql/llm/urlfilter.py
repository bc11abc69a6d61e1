"""URL filters with DataFrame functions only, after the way of hash-prefix block lists.

Each url is expanded into expressions, host suffix times path prefix: the suffixes of its host at label bounds, and of
its path the prefixes of the lengths that rules have. The expressions' short hash prefixes are equi-joined with the
rules'; what joins is confirmed by the full digest, and the longest rule wins: by host, then by path, then block before
allow.

A url is expanded once however many rows have it, and results are joined back by url. The rules' path lengths are
collected up to MOST_LENGTHS distinct ones; beyond, they are joined by the length instead. No side is broadcast by
hand; Spark does so only for one below its size threshold.

Defined results: a null url, or one without `://`, has an empty host and path, and as no rule has an empty host gets no
rule and the default verdict; rules with a null part or an empty host are left out; a null rule path is empty; equal
rules count once; extra columns of the pages play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the digest on which urls and rules are joined.
PREFIX = 8
#: Verdict of a url that no rule fits.
DEFAULT = "allow"
MOST_LENGTHS = 256

#: The rules of the op10 query, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def rules_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "verdict string, host string, path string")


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    rules = rules.select("verdict", "host", F.coalesce("path", F.lit("")).alias("path")).where("verdict IS NOT NULL AND host <> ''")
    # A verdict per rule: block before allow.
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    lengths = [r[0] for r in rules.select(F.char_length("path")).distinct().limit(MOST_LENGTHS + 1).collect()]
    full = _digest(F.col("host"), F.col("path"))
    rules = rules.select(
        full.alias("rule_digest"), F.left(full, F.lit(PREFIX)).alias("short"), F.concat("host", "path").alias("rule"), "verdict",
        F.struct(F.char_length("host").alias("h"), F.char_length("path").alias("p")).alias("length"),
    )
    urls = pages.select("url").where(F.col("url").contains("://")).distinct().withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    if len(lengths) <= MOST_LENGTHS:
        fits = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.char_length("path"))
    else:  # every prefix that the path has
        fits = F.sequence(F.lit(0), F.char_length("path"))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(fits, lambda n: _digest(h, F.left("path", n)))))
    expanded = urls.where("host <> ''").select("url", F.explode(expressions).alias("digest"))
    expanded = expanded.withColumn("short", F.left("digest", F.lit(PREFIX)))
    # A candidate by the short prefix counts only if the full digest agrees.
    found = expanded.join(rules, "short").where(F.col("digest") == F.col("rule_digest"))
    best = found.groupBy(F.col("url").alias("judged")).agg(F.max(F.struct("length", "verdict", "rule")).alias("best"))
    out = pages.select("page_id", "url").join(best, F.col("url") == F.col("judged"), "left")
    return out.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
