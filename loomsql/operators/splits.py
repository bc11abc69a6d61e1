"""Group-consistent splits, holdouts, summaries and the leakage audit."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsql.functions import keys

#: Fixed values.
SPLITS = ["train", "validation", "test_in_domain", "test_ood"]


def choose_split(
    family: Column, *, schema_family: Column, template_id: Column, complexity: Column, validation: Iterable[str] = (), in_domain: Iterable[str] = (),
    ood_schema_families: Iterable[str] = (), ood_template_ids: Iterable[str] = (), hard_complexity_to_ood: bool = False, in_domain_eval_ratio: float = 0.2,
) -> Column:
    """The first rule that fits: out-of-domain schema, template, hard queries, holdouts, the hash bucket; else train."""
    ood = schema_family.isin(list(ood_schema_families)) | template_id.isin(list(ood_template_ids))
    if hard_complexity_to_ood:
        ood |= complexity == "hard"
    return (
        F.when(F.coalesce(ood, F.lit(False)), "test_ood")
        .when(family.isin(list(validation)), "validation")
        .when(family.isin(list(in_domain)), "test_in_domain")
        .when(keys.split_bucket(family) < int(in_domain_eval_ratio * 100), "test_in_domain")
        .otherwise("train")
    )


def build_splits(df: DataFrame, order: str, **rules) -> DataFrame:
    """The rows with `split`: chosen from the first row of each template family. Families are aggregated (combined
    before the shuffle) and joined back; Spark broadcasts them while they are small."""
    family = keys.template_family_key()
    first = F.struct("schema_family", "template_id", "complexity")
    chosen = df.groupBy(family.alias("family")).agg(F.min_by(first, order).alias("f"), F.min(order).alias("family_first"))
    split = choose_split(F.col("family"), schema_family=F.col("f.schema_family"), template_id=F.col("f.template_id"), complexity=F.col("f.complexity"), **rules)
    chosen = chosen.select("family", "family_first", split.alias("split"))
    return df.drop("split").withColumn("family", family).join(chosen, "family").drop("family")


def template_family_ids(df: DataFrame) -> DataFrame:
    return df.select(keys.template_family_key().alias("family")).distinct()


def holdouts(df: DataFrame, count: int, order: str, skip: Iterable[str] = ()) -> DataFrame:
    """The first `count` families in row order that aren't skipped."""
    found = df.groupBy(keys.template_family_key().alias("family")).agg(F.min(order).alias("first_row"))
    return found.where(~F.col("family").isin(list(skip))).orderBy("first_row").limit(max(count, 0))


def split_counts(df: DataFrame) -> DataFrame:
    """Rows of each split, 0 for a usual one without rows."""
    usual = df.sparkSession.createDataFrame([(s, 0) for s in SPLITS], "split string, n long")
    return usual.unionByName(df.groupBy("split").agg(F.count("*").alias("n"))).groupBy("split").agg(F.sum("n").alias("n_rows"))


def split_summary(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(F.concat_ws(":", "split", by).alias("name")).agg(F.count("*").alias("n_rows"))


def task_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("task").agg(F.count("*").alias("n_rows"))


def leakage_details(df: DataFrame) -> DataFrame:
    """kind, value, n_splits of all keys that occur in two splits or more: one aggregation, no join of splits."""
    kinds = {"exact": keys.exact_audit_key(), "ast": F.col("source_ast_hash"), "semantic": F.col("semantic_hash"), "template_family": keys.template_family_key()}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()]))
    rows = df.select("split", pairs.alias("p")).select("split", "p.kind", "p.value")
    rows = rows.where((F.col("kind") == "exact") | (F.coalesce("value", F.lit("")) != ""))
    return rows.groupBy("kind", "value").agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")


def leakage_counts(df: DataFrame) -> DataFrame:
    """Shared keys of each kind, 0 where there are none."""
    kinds = df.sparkSession.createDataFrame([(k, 0) for k in ("exact", "ast", "semantic", "template_family")], "kind string, n long")
    found = leakage_details(df).groupBy("kind").agg(F.count("*").alias("n"))
    return kinds.unionByName(found).groupBy("kind").agg(F.sum("n").alias("n_shared"))
