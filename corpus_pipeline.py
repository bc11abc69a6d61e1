"""A corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

Defined results of all stages: an empty table gives no rows; extra columns stay, whatever their names; texts of any
length are judged whole; the order of rows doesn't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomsql.llm import bagminhash, decontaminate, mixing, quality, scratch, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on its training fold of the labels, doesn't reject.

    A null or empty text has the score of the model's bias, so it stays unless most labels are toxic; rows of equal texts
    fare alike; a score of exactly 0.5 is rejected; without labels all scores are 0.5, so no row stays."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on its training fold of the labels, takes for good.

    A null or empty text has the score of the model's bias, so it stays if most labels are good; rows of equal texts fare
    alike; a score of exactly 0.5 is good; without labels all scores are 0.5, so all rows stay."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least doc_id.

    Null and empty texts are one class, a null id is the least of a class only if all are null; of rows that repeat both
    text and id one stays, whichever; a similarity of exactly 0.8 is near."""
    return bagminhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window.

    A null or empty text has no words and stays; items without words or id forbid nothing, and without items all rows
    stay; rows of equal texts fare alike."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by calibrated probabilities, with the probability of each.

    A null text is empty, null sources and languages are values of their own; rows of one id share one draw, so repeated
    rows stay or go together; the probability is a last column mix_p."""
    return mixing.sample(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", keep_good),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mix),
]

#: Trained models and signatures have no SQL form; tests/llm recomputes which rows each stage keeps of its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
