"""Keep-first deduplication, capped groups and truncation. Row order is always an explicit column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column has it in upper or lower case."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key. One shuffle by key; Spark limits groups before it (WindowGroupLimit)."""
    k, n = fresh(df, "key"), fresh(df, "rank")
    w = Window.partitionBy(k).orderBy(order)
    return df.withColumn(k, key).withColumn(n, F.row_number().over(w)).where(F.col(n) == 1).drop(k, n)


def keep_first_stats(df: DataFrame, key: Column) -> DataFrame:
    """Counts only: partial aggregation by key, no window."""
    per_key = df.select(key.alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("input_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("removed_exact_duplicates"),
        F.count("*").alias("output_rows"),
    )


def group_counts(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("group_rows"))


def cap_variants(df: DataFrame, group: Column, variant: Column, fallback: Column, order: str, most: int) -> DataFrame:
    """Per group the first row of each variant (the fallback where it is null or empty), then the first `most` of those,
    with their rank: groups in first-seen order, rows in order inside."""
    g, v, n = fresh(df, "group"), fresh(df, "variant"), fresh(df, "rank")
    named = df.withColumn(g, group).withColumn(v, F.when(F.coalesce(variant, F.lit("")) == "", fallback).otherwise(variant))
    first = named.withColumn(n, F.row_number().over(Window.partitionBy(g, v).orderBy(order))).where(F.col(n) == 1)
    # Ranked and cut first, so that Spark limits each group before it is sorted; its first row is always among the rest.
    capped = first.withColumn(n, F.row_number().over(Window.partitionBy(g).orderBy(order))).where(F.col(n) <= most)
    return capped.withColumn("group_first", F.min(order).over(Window.partitionBy(g))).drop(g, v, n)


def truncate(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """The first rows in a total order: top-k by task, then of the tasks' results."""
    return df.orderBy(*order).limit(rows)
