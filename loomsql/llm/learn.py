"""Fitting a subword classifier on a bounded sample of labelled documents, and scoring a column of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import subword as sw

#: Labelled documents of each class, and bytes of their texts, that a classifier is fitted on at most (the bounds of the
#: sample; the text that reaches the second bound is the last one taken).
SAMPLE_PER_CLASS, SAMPLE_BYTES = 1500, 8 << 20


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, mod by; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % by


def fit(docs: DataFrame, labels: DataFrame, label: str, trained_on: Column, config: sw.Config, per_class: int = SAMPLE_PER_CLASS, class_bytes: int = SAMPLE_BYTES) -> sw.Model:
    """Fit on the rows of `labels` for which `trained_on` holds (a condition on doc_id), in one task of an executor; the
    driver gets the model only.

    Of each class the documents of the least hashes of the id are taken, at most `per_class` of them and as long as the
    texts before them have less than `class_bytes`, whatever the size of the input; the classes' shares are counted over
    all labelled rows. Null labels, and labels without a document, teach nothing; of repeated ids one row counts (the
    greater label, the lesser text). No labels: score 0.5.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(trained_on)
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    # Two short aggregations: of each class, its size and its ids of least hash.
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit(label))
    picked = None
    for value in (0, 1):
        part = rows.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    # The broadcast side has 2 * per_class rows at most; the groupBy keeps repeated ids from growing the sample.
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    before = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.partitionBy("label").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < class_bytes)
    known = counts.get(0, 0) + counts.get(1, 0)
    prior = counts.get(1, 0) / known if known else None

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, said = sw.Sample(config), []
        for batch in batches:
            sample.add(batch.column("text"))
            said += batch.column("label").to_pylist()
        m = sw.train(sample.done(), np.array(said, np.int64), prior)
        yield pa.RecordBatch.from_pydict({"weight": [m.weight.tobytes()], "bias": [m.bias], "n": [m.fitted_rows]})

    made = found.select("doc_id", "label", "text").coalesce(1).sortWithinPartitions("doc_id").mapInArrow(trained, "weight binary, bias double, n bigint").collect()
    model = [sw.Model(config, np.frombuffer(r["weight"], np.float32), r["bias"], r["n"]) for r in made if r["n"]]
    return model[0] if model else sw.Model(config, np.zeros(config.buckets, np.float32), 0.0)


def score(model: sw.Model, text: str) -> Column:
    """Probability of label 1 of the whole text; computed in Arrow batches, from that column alone."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(sw.score(model, column))

    return scored(F.col(text))


def scored(docs: DataFrame, model: sw.Model, by: int, held_out: int) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = docs.select("doc_id", (remainder("doc_id", by) == held_out).alias("held_out"), score(model, "text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
