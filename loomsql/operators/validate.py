"""Checks that need Spark's own parser and analyzer; they run on the driver, text by text."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

#: Texts that are parsed at a time.
THREADS = 8
_RESERVED = "spark.sql.ansi.enforceReservedKeywords"


def parse_all(spark: SparkSession, texts: list[str | None]) -> list[str]:
    """The error of each text, empty for one that parses. Reserved words are enforced meanwhile, so that SELECT FROM is no
    query."""
    session, before = spark._jsparkSession, spark.conf.get(_RESERVED)
    parser = session.sessionState().sqlParser()

    def begun() -> None:
        spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(session)

    def parsed(sql: str | None) -> str:
        if not (sql or "").strip():
            return "SQL is blank"
        try:
            parser.parsePlan(sql)  # names are resolved elsewhere
        except ParseException as e:
            return str(e).strip().split("\n")[0]
        return ""

    spark.conf.set(_RESERVED, "true")
    try:
        with ThreadPoolExecutor(THREADS, initializer=begun) as pool:
            return list(pool.map(parsed, texts))
    finally:
        spark.conf.set(_RESERVED, before)


def parse_sql(spark: SparkSession, sql: str) -> tuple[bool, str]:
    """(valid, error)."""
    error = parse_all(spark, [sql])[0]
    return not error, error


_TOKEN = re.compile(r"'[^']*'|[A-Za-z_][A-Za-z0-9_]*|[0-9]+")


def shape_of(sql: str | None, keywords: set[str]) -> str:
    """The text with x for each name that is no keyword, '' for each string and 0 for each number: what the parser's answer
    depends on, but for the words of its messages."""
    one = lambda m: "''" if m[0][0] == "'" else "0" if m[0][0].isdigit() else m[0] if m[0].upper() in keywords else "x"
    return _TOKEN.sub(one, sql or "")


def with_parse_errors(rows: DataFrame, text: str, name: str = "parse_errors", by_shape: bool = False) -> DataFrame:
    """The rows with an array of what the parser says of a text, empty for one that parses. Distinct texts go to the
    driver, so there have to be few of them. by_shape: texts of one shape are parsed once and share a message."""
    spark = rows.sparkSession
    texts = [r[0] for r in rows.select(text).distinct().collect()]
    if by_shape:
        keywords = {r[0].upper() for r in spark.sql("SELECT keyword FROM sql_keywords()").collect()}
        shapes = [shape_of(t, keywords) for t in texts]
        distinct = sorted(set(shapes))
        of = dict(zip(distinct, parse_all(spark, distinct), strict=True))
        errors = [of[s] for s in shapes]
    else:
        errors = parse_all(spark, texts)
    key = name + "_of"
    said = spark.createDataFrame([(t, [e] if e else []) for t, e in zip(texts, errors, strict=True)], f"{key} string, {name} array<string>")
    return rows.join(said, rows[text].eqNullSafe(said[key])).drop(key)


def execute(spark: SparkSession, sql: str) -> DataFrame:
    """Run a generated query against the views that are registered."""
    return spark.sql(sql)
