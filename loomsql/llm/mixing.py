"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by cell (source, language, topic). Raking scales the cells until their sums over each margin are the
target's; a document's weight is its cell's factor. Documents are then sampled by calibrated probabilities
min(1, k * weight), k such that the expected tokens are the budget.

Targets: shares by value, or by default the margin's own shares to the power TEMPER (0: all values alike). A topic is the
group of the hashed vocabulary that has most of a document's long words; a document without long words has topic -1. That
is a stand-in for tables without topics: a column of topics can be named instead.

The cells are few (values of source times languages times topics): up to MOST_CELLS, with names of MOST_BYTES, are raked
in numpy on the driver and broadcast; more are raked as DataFrames, a table written each round, and joined without a hint.

Defined results: a null source, language or topic is a value of its own; texts of any length are measured whole, in
slices; a null text is empty, and cells without tokens have
weight 1; a target for a value that isn't there has no effect, values without a target get weight 0, and where no value
has one all have equal shares; targets that no cell can meet together leave weights of 0; the same id draws the same
number in every row; an empty table gives no rows; extra columns stay, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import bytesops as bo
from .scratch import fresh, written

MARGINS = ("source", "lang", "topic")
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.0}
TOPICS, LONG_WORD, BUDGET, ROUNDS, TOLERANCE = 8, 7, 0.5, 200, 1e-9
#: Cells, and bytes of their names, that are raked on the driver and broadcast at most.
MOST_CELLS, MOST_BYTES = 20_000, 2 << 20


def measured(column: pa.Array) -> pa.Array:
    """n_tokens (words of letters and digits) and topic of each text."""
    n, topic = [], []
    for _, part in bo.slices(bo.texts(column)):
        data, offsets = bo.separated(part)
        data = bo.lowered(data)
        starts, ends = bo.spans(data, bo.ALNUM)
        n.append(np.diff(bo.rows_of(starts, offsets)))
        long = ends - starts >= LONG_WORD
        starts, ends = starts[long], ends[long]
        group = (bo.hashed(bo.prefix_sums(data), starts, ends) % np.uint64(TOPICS)).astype(np.int64)
        doc = np.repeat(np.arange(len(part)), np.diff(bo.rows_of(starts, offsets)))
        counts = np.bincount(doc * TOPICS + group, minlength=len(part) * TOPICS).reshape(-1, TOPICS)
        topic.append(np.where(counts.sum(axis=1) > 0, counts.argmax(axis=1), -1))
    none = np.zeros(0, np.int64)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(n or [none]).astype(np.int64)), pa.array(np.concatenate(topic or [none]).astype(np.int64))], names=["n_tokens", "topic"])


def rake(values: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """Factors of the cells. values: of each margin the cells' value numbers; targets: shares by value number."""
    factor = np.ones(len(tokens))
    if not tokens.sum():
        return factor
    for _ in range(ROUNDS):
        worst = 0.0
        for of, target in zip(values, targets, strict=True):
            now = np.bincount(of, tokens * factor, len(target))
            there = now > 0
            goal = np.where(there, target, 0)
            goal = goal / (goal.sum() or 1.0) * tokens.sum()
            step = np.where(there, goal / np.where(there, now, 1), 1)
            worst = max(worst, float(np.abs(step[there] - 1).max(initial=0)))
            factor *= step[of]
        if worst < TOLERANCE:
            break
    return factor


def shares(totals: np.ndarray, names: list, given: dict | None, temper: float) -> np.ndarray:
    out = np.array([given.get(n, 0.0) for n in names], float) if given else np.where(totals > 0, totals, 0.0) ** temper * (totals > 0)
    return out / out.sum() if out.sum() else np.full(len(names), 1 / max(len(names), 1))


def calibrated(weight: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """min(1, k * weight) with sum(tokens * that) = budget, as far as weights above 0 reach; by bisection over k."""
    low, high = 0.0, 1.0
    while (tokens * np.minimum(1, high * weight)).sum() < min(budget, tokens[weight > 0].sum() * (1 - 1e-12)) and high < 1e18:
        high *= 2
    for _ in range(200):
        k = (low + high) / 2
        low, high = (k, high) if (tokens * np.minimum(1, k * weight)).sum() < budget else (low, k)
    return np.minimum(1, high * weight)


def _rake_frames(cells: DataFrame, targets: dict, budget: float) -> DataFrame:
    """The same for any number of cells: each round is written and its margins joined back."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    state = written(cells.withColumn("weight", F.lit(1.0)), "cells")
    if not total:
        return state.withColumn("p", F.lit(1.0))
    given = {}
    for m in MARGINS:
        if targets.get(m):  # a value of another type can't occur
            text = cells.schema[m].dataType == StringType()
            pairs = [(v if v is None or text else int(v), float(t)) for v, t in targets[m].items() if v is None or isinstance(v, str if text else (int, np.integer))]
            aims = cells.sparkSession.createDataFrame(pairs, f"_v {cells.schema[m].dataType.simpleString()}, _aim double")
            there = state.select(m).distinct()
            there = written(there.join(aims, there[m].eqNullSafe(aims["_v"]), "left").select(F.col(m).alias("_v"), F.coalesce("_aim", F.lit(0.0)).alias("_aim")), "targets")
            # As in shares(): equal shares where no value has a target.
            given[m] = there if there.agg(F.sum("_aim")).first()[0] else there.withColumn("_aim", F.lit(1.0))
    for _ in range(ROUNDS):
        worst = 0.0
        for m in MARGINS:
            sums = state.groupBy(m).agg(F.sum(F.col("tokens") * F.col("weight")).alias("now"), F.sum("tokens").alias("own"))
            if m in given:
                sums, goal = sums.join(given[m], sums[m].eqNullSafe(given[m]["_v"])), F.col("_aim")
            else:
                goal = F.when(F.col("own") > 0, F.pow("own", F.lit(TEMPER[m]))).otherwise(0.0)
            sums = sums.withColumn("goal", F.when(F.col("now") > 0, goal).otherwise(0.0))
            whole = sums.agg(F.sum("goal")).first()[0] or 1.0
            sums = sums.select(F.col(m).alias("_m"), F.when(F.col("now") > 0, F.col("goal") / whole * total / F.col("now")).otherwise(1.0).alias("step"))
            sums = written(sums, "margin")
            worst = max(worst, sums.agg(F.max(F.abs(F.col("step") - 1))).first()[0] or 0.0)
            state = written(state.join(sums, state[m].eqNullSafe(sums["_m"])).withColumn("weight", F.col("weight") * F.col("step")).drop("_m", "step"), "cells")
        if worst < TOLERANCE:
            break
    low, high = 0.0, 1.0
    expected = lambda k: state.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.lit(k) * F.col("weight")))).first()[0]
    reach = state.where("weight > 0").agg(F.sum("tokens")).first()[0] or 0
    while expected(high) < min(budget * total, reach * (1 - 1e-12)) and high < 1e18:
        high *= 2
    for _ in range(60):
        k = (low + high) / 2
        low, high = (k, high) if expected(k) < budget * total else (low, k)
    return state.withColumn("p", F.least(F.lit(1.0), F.lit(high) * F.col("weight")))


def draw(id_col: str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def mixture(docs: DataFrame, targets: dict | None = None, budget: float = BUDGET, most_cells: int = MOST_CELLS, name: str = "mix", topic: str | None = None) -> DataFrame:
    """The rows with a column `name`: n_tokens, topic, weight, p (probability of being kept) and kept. topic: a column
    that holds the topics; without it they are taken from the texts' words."""
    targets = targets or {}

    @F.arrow_udf("struct<n_tokens:bigint,topic:bigint>")
    def measure(column: pa.Array) -> pa.Array:
        return measured(column)

    told, own = docs.withColumn(name, measure(F.col("text"))), F.col(f"{name}.topic")
    if topic:
        own = F.col(topic)
        told = told.withColumn(name, F.struct(F.col(f"{name}.n_tokens"), own.alias("topic")))
    cells = written(told.groupBy("source", "lang", F.col(f"{name}.topic").alias("topic")).agg(F.sum(f"{name}.n_tokens").cast("double").alias("tokens")), "cells")
    size = cells.agg(F.count("*").alias("n"), F.sum(sum(F.coalesce(F.octet_length(F.col(m).cast("string")), F.lit(0)) for m in MARGINS)).alias("bytes")).first()
    s, g, t, fit = (fresh(x, told) for x in ("of_source", "of_lang", "of_topic", "fitted"))
    if size["n"] <= most_cells and (size["bytes"] or 0) <= MOST_BYTES:
        rows = cells.collect()
        tokens = np.array([r["tokens"] for r in rows], float)
        values, goals = [], []
        for m in MARGINS:
            names = sorted({r[m] for r in rows}, key=lambda v: (v is None, str(v)))
            number = {v: k for k, v in enumerate(names)}
            of = np.array([number[r[m]] for r in rows], np.int64)
            values.append(of)
            goals.append(shares(np.bincount(of, tokens, len(names)), names, targets.get(m), TEMPER[m]))
        weight = rake(values, tokens, goals)
        p = calibrated(weight, tokens, budget * tokens.sum()) if tokens.sum() else np.ones(len(rows))
        made = [(r["source"], r["lang"], r["topic"], float(w), float(q)) for r, w, q in zip(rows, weight, p, strict=True)]
        kinds = [cells.schema[m].dataType.simpleString() for m in MARGINS]
        fitted = F.broadcast(docs.sparkSession.createDataFrame(made, f"source {kinds[0]}, lang {kinds[1]}, topic {kinds[2]}, weight double, p double"))
    else:
        fitted = _rake_frames(cells, targets, budget)
    fitted = fitted.select(F.col("source").alias(s), F.col("lang").alias(g), F.col("topic").alias(t), F.struct("weight", "p").alias(fit))
    same = F.col("source").eqNullSafe(F.col(s)) & F.col("lang").eqNullSafe(F.col(g)) & F.col(f"{name}.topic").eqNullSafe(F.col(t))
    out = told.join(fitted, same, "left")
    mix = F.struct(F.col(f"{name}.n_tokens"), F.col(f"{name}.topic"), F.col(f"{fit}.weight").alias("weight"), F.col(f"{fit}.p").alias("p"), (draw("doc_id") < F.col(f"{fit}.p")).alias("kept"))
    return out.select(*[F.col(c) for c in docs.columns], mix.alias(name))


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, p, kept of every row."""
    return mixture(docs.select("doc_id", "text", "source", "lang")).select("doc_id", "source", "lang", "mix.topic", "mix.n_tokens", "mix.weight", "mix.p", "mix.kept")


def sample(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with all their columns and a last one, the probability that they had."""
    name, p = fresh("mix", docs), fresh("mix_p", docs)
    return mixture(docs, name=name).where(F.col(f"{name}.kept")).select(*[F.col(c) for c in docs.columns], F.col(f"{name}.p").alias(p))
