"""MinHash near-duplicates of multisets: BagMinHash signatures, bands, and a check of the multiset overlap.

A document is the multiset of its shingles of five consecutive words (A-Z lower-cased runs of letters and digits; a text
of one to four words is one shingle). For a shingle of weight w, Poisson processes run over the discretised weights
[0, 1), [1, 2), [2, 4), [4, 8), ... as far as w reaches, each with the rate of its width; a point has a time, a place in
its interval and a signature component, all from hashes of the shingle, so equal for all documents. Places at or above w
are left out. A component's value is the least time that it gets, and two documents agree in a component with exactly
the probability of their weighted Jaccard similarity. A process ends once its time exceeds the document's largest value,
so most shingles cost one or two points whatever the signature's length.

Candidates: of each bucket of equal bands one leader (by a hash that differs by band) is compared with each other text.
A candidate counts if sum(min) / sum(max) of the multisets is at least the threshold. Classes are the components of what
counts. Most buckets are then of one class. In each other one the texts outside of its largest class are compared with
all of its texts, in blocks of bounded size: a block gives the links that join classes, never its pairs. So no link
between two classes of a bucket is lost, and the pairs within a large class are not made.

Equal texts are one node from the start. Nodes are MD5 digests of whole texts. Signatures: with 100 components in 20
bands a pair of similarity 0.8 shares a bucket with probability 0.9996.

Defined results: a null text is an empty one; texts without words are near only to equal texts; a class is named by the
least doc_id in it (null only if all its ids are null); repeated rows are in one class; extra columns play no part; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytesops as bo
from .components import components
from .scratch import dropped, fresh, written

WORDS, BANDS, ROWS, THRESHOLD = 5, 20, 5, 0.8
#: Texts and bytes of bags in a side of a block, on average: bounds of what a task holds, not of what is compared.
BLOCK_TEXTS, BLOCK_BYTES = 512, 4 << 20
#: Shingles that a block's texts are laid out by at once.
_COLUMNS = 4096
#: Points made at once in a round of the signature's processes.
_POINTS = 200_000
#: Units of time in the mean gap of a process of rate one.
_UNIT = 2.0**44


def shingles(array: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, and the n + 1 bounds of each text's. Texts are a slice."""
    data, offsets = bo.separated(array)
    starts, ends = bo.spans(bo.lowered(data), bo.ALNUM)
    keys = bo.hashed(bo.prefix_sums(bo.lowered(data)), starts, ends)
    bounds = bo.rows_of(starts, offsets)
    counts = np.diff(bounds)
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    first = np.repeat(bounds[:-1], sizes) + _within(sizes)
    left = np.repeat(np.minimum(counts, words), sizes)
    out = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            on = k < left
            out[on] = bo.mix(out[on] * np.uint64(0x9E3779B97F4A7C15) + keys[first[on] + k] + np.uint64(1))
    return out, np.concatenate(([0], np.cumsum(sizes)))


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def bags(array: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), sorted by text and shingle, each shingle once in a text."""
    keys, bounds = shingles(array, words)
    doc = np.repeat(np.arange(len(array)), np.diff(bounds))
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], keys[at], np.diff(np.append(at, len(keys)))


def signatures(doc: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int, size: int = BANDS * ROWS) -> np.ndarray:
    """n x size values; the greatest integer for a text without shingles. Times are whole numbers, so that their sums are
    equal whatever else is in the batch."""
    out = np.full(n * size, np.iinfo(np.int64).max)
    # A process for each interval that the weight reaches.
    levels = 1 + np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)
    which = np.repeat(np.arange(len(keys)), levels)
    level = _within(levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.where(level > 0, low, 1)
    p_doc, p_weight = doc[which], weights[which]
    with np.errstate(over="ignore"):
        seed = bo.mix(keys[which] + level.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        time, made = np.zeros(len(which), np.int64), 0
        live = np.arange(len(which))
        while len(live):
            each = int(np.clip(_POINTS // len(live), 1, 64))
            step = np.arange(made + 1, made + each + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            made += each
            one = bo.mix(seed[live, None] + step)
            two = bo.mix(one ^ np.uint64(0xA0761D6478BD642F))
            gap = -np.log(((one >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / width[live, None]
            times = time[live, None] + np.cumsum(np.rint(gap * _UNIT).astype(np.int64), axis=1)
            part = ((two >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
            place = low[live, None] + (two & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32 * width[live, None]
            ok = place < p_weight[live, None]
            np.minimum.at(out, (p_doc[live, None] * size + part.astype(np.int64))[ok], times[ok])
            time[live] = times[:, -1]
            most = out.reshape(n, size).max(axis=1)
            live = live[time[live] < most[p_doc[live]]]
    return out.reshape(n, size)


def bands(column: pa.Array, n_bands: int = BANDS, rows: int = ROWS) -> pa.Array:
    """A list of band hashes for each text; an empty one for a text without words."""
    array = bo.texts(column)
    hashes, sizes = [np.zeros(0, np.uint64)], [0]
    for _, part in bo.slices(array):
        doc, keys, weights = bags(part)
        values = signatures(doc, keys, weights, len(part), n_bands * rows).view(np.uint64).reshape(len(part), n_bands, rows)
        h = np.zeros((len(part), n_bands), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(rows):
                h = bo.mix(h * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
        some = np.bincount(doc, minlength=len(part)) > 0
        hashes.append(h[some].ravel())
        sizes.extend((some * n_bands).tolist())
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(hashes).view(np.int64)))


def packed(column: pa.Array) -> pa.Array:
    """Each text's bag as the bytes of a set, ascending, 8 bytes each: the first, second, ... of equal shingles are
    different elements, so sum(min) of two bags is the size of their sets' intersection."""
    out = []
    for _, part in bo.slices(bo.texts(column)):
        doc, keys, weights = bags(part)
        with np.errstate(over="ignore"):
            keys = np.repeat(keys, weights) + _within(weights).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        doc = np.repeat(doc, weights)
        keys = keys[np.lexsort((keys, doc))]
        at = np.searchsorted(doc, np.arange(len(part) + 1))
        out += [keys[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
    return pa.array(out, pa.binary())


def overlap(one: bytes, two: bytes) -> float:
    """sum(min) / sum(max) of two packed bags; 0 if both are empty."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    both = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - both
    return both / total if total else 0.0


def overlaps(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """The overlap of each packed bag of one with each of two."""
    sizes = np.array([len(z) // 8 for z in one + two])
    elements, row = np.frombuffer(b"".join(one + two), np.uint64), np.repeat(np.arange(len(sizes)), sizes)
    found, column, n = np.unique(elements, return_inverse=True, return_counts=True)
    shared = np.cumsum(n > 1) - 1  # what only one text has is in no intersection
    on = n[column] > 1
    row, column = row[on], shared[column[on]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(one), len(two)))
    for start in range(0, int((n > 1).sum()), _COLUMNS):
        a, b = np.searchsorted(column, (start, start + _COLUMNS))
        has = np.zeros((len(sizes), _COLUMNS), np.float32)
        has[row[a:b], column[a:b] - start] = 1
        both += has[: len(one)] @ has[len(one) :].T
    return both / np.maximum(sizes[: len(one), None] + sizes[None, len(one) :] - both, 1)


def joining(roots_one: np.ndarray, roots_two: np.ndarray, near: np.ndarray) -> list[tuple]:
    """Pairs of roots, without cycles, that join all that the near texts of two sides join."""
    names, code = np.unique(np.concatenate((roots_one, roots_two)), return_inverse=True)
    i, j = np.nonzero(near)
    a, b = code[i], code[len(roots_one) + j]
    pairs = np.unique(np.minimum(a, b)[a != b] * len(names) + np.maximum(a, b)[a != b])
    root, out = list(range(len(names))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for pair in pairs.tolist():
        x, y = find(pair // len(names)), find(pair % len(names))
        if x != y:
            root[y] = x
            out.append((names[pair // len(names)], names[pair % len(names)]))
    return out


def _key(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def _members(nodes: DataFrame) -> DataFrame:
    """key, band, hash: each text in each of its buckets."""
    return nodes.select("key", F.posexplode("bands").alias("band", "hash"))


def _candidates(nodes: DataFrame) -> DataFrame:
    """one, two: each text of a bucket of more than one, with the bucket's leader."""
    members = _members(nodes)
    # The leader is a minimum, so it is combined before the shuffle, and the join back can be split where it is skewed.
    leaders = members.groupBy("band", "hash").agg(F.min_by("key", F.xxhash64("key", "band")).alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = members.join(leaders, ["band", "hash"]).where("key <> leader")
    return found.select(F.greatest("key", "leader").alias("one"), F.least("key", "leader").alias("two")).distinct()


def _place() -> Column:
    """Of a row with a key and a doc_id, what tells copies of one text apart; null ids too."""
    return F.xxhash64("key", "doc_id", F.col("doc_id").isNull()).alias("place")


def _bags(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, bag, size of the texts that occur in pairs. Of each text the rows of the one id that its node has are joined,
    so copies of one text don't meet in one task."""
    wanted = pairs.select(F.col("one").alias("key")).union(pairs.select("two")).distinct()
    wanted = nodes.join(wanted, "key", "left_semi").select("key", _place())

    @F.arrow_udf("binary")
    def bag(column: pa.Array) -> pa.Array:
        return packed(column)

    rows = docs.select("doc_id", "text", _key("text").alias("key")).select("key", _place(), "text")
    texts = rows.join(wanted, ["key", "place"], "left_semi").dropDuplicates(["key", "place"])
    return texts.select("key", bag("text").alias("bag")).withColumn("size", F.octet_length("bag"))


def links(pairs: DataFrame, found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (one, two, ...) whose multisets, from the bags found, overlap by the threshold."""

    @F.arrow_udf("double")
    def similar(one: pa.Array, two: pa.Array) -> pa.Array:
        return pa.array([overlap(a, b) for a, b in zip(one.to_pylist(), two.to_pylist(), strict=True)], pa.float64())

    sides = [found.select(F.col("key").alias(k), F.col("bag").alias(f"bag_{k}")) for k in ("one", "two")]
    checked = pairs.join(sides[0], "one").join(sides[1], "two")
    return checked.where(similar("bag_one", "bag_two") >= threshold).drop("bag_one", "bag_two")


def _merged(rows: DataFrame, step: DataFrame) -> DataFrame:
    """The rows with the root of each root; a root that step doesn't have stays."""
    step = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
    return rows.join(step, "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to")


def _blocks(members: DataFrame, sizes: DataFrame, texts: int) -> DataFrame:
    """band, hash, one, two, side, key, root: the sides of blocks, one <= two, of each bucket that holds three texts or
    more and two classes or more. Its largest class is dealt to the first chunks, which don't meet each other; the rest
    to further chunks, which meet all. Classes are counted before the shuffle, and no bucket is gathered."""
    of = ["band", "hash"]
    members = members.join(sizes, "key")
    counted = members.groupBy(*of, "root").agg(F.count("*").alias("c"), F.sum("size").alias("s"))
    largest = F.max(F.struct("c", "s", "root"))
    bucket = counted.groupBy(*of).agg(F.sum("c").alias("n"), F.count("*").alias("roots"), F.sum("s").alias("all"), largest.alias("l"))
    chunks = lambda n, size: F.ceil(F.greatest(n / float(texts), size / float(BLOCK_BYTES))).cast("long")
    bucket = bucket.where("n > 2 AND roots > 1").select(
        *of, F.col("l.root").alias("top"), chunks(F.col("l.c"), F.col("l.s")).alias("first"), chunks(F.col("n") - F.col("l.c"), F.col("all") - F.col("l.s")).alias("rest")
    )
    place = F.xxhash64("key", "band")
    dealt = members.drop("size").join(bucket, of).withColumn("rest_of", F.col("root") != F.col("top"))
    dealt = dealt.withColumn("own", F.when(F.col("rest_of"), F.col("first") + F.pmod(place, "rest")).otherwise(F.pmod(place, "first")))
    met = F.sequence(F.when(F.col("rest_of"), F.lit(0)).otherwise(F.col("first")), F.col("first") + F.col("rest") - 1)
    dealt = dealt.select("key", "root", *of, "own", F.explode(met).alias("other"))
    return dealt.select("key", "root", *of, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), (F.col("own") > F.col("other")).alias("side"))


def _joined(blocks: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """root_one, root_two: classes that the texts of a block join."""

    def compare(block: pa.Table) -> pa.Table:
        side, root, bag = (block.column(c).to_numpy(zero_copy_only=False) for c in ("side", "root", "bag"))
        a = np.flatnonzero(~side.astype(bool))
        b = np.flatnonzero(side) if block.column("one")[0].as_py() != block.column("two")[0].as_py() else a
        near = overlaps([bag[i] for i in a], [bag[i] for i in b]) >= threshold
        out = joining(root[a], root[b], near)
        return pa.table({"root_one": pa.array([x for x, _ in out], pa.string()), "root_two": pa.array([y for _, y in out], pa.string())})

    rows = blocks.join(found.select("key", "bag"), "key").drop("key")
    return rows.groupBy("band", "hash", "one", "two").applyInArrow(compare, "root_one string, root_two string")


def roots(docs: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """key, root: the class of each text. Links with the leaders of buckets make classes; then the blocks of the buckets
    of several classes join what no leader did."""
    pairs = written(_candidates(nodes), "pairs")
    # Whoever shares a bucket is in one of these pairs, so the blocks need no text.
    found = written(_bags(docs, nodes, pairs), "bags")
    step = components(links(pairs, found, threshold), "one", "two")
    named = written(_merged(nodes.select("key", F.col("key").alias("root")), step), "roots")
    dropped(pairs)
    blocks = _blocks(_members(nodes).join(named, "key"), found.select("key", "size"), block_texts)
    joined = written(_joined(blocks, found, threshold).distinct(), "joined")
    dropped(found)
    return _merged(named, written(components(joined, "root_one", "root_two"), "step"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key of every row; key, class_id, class_key of every different text)."""

    @F.arrow_udf("array<bigint>")
    def banded(column: pa.Array) -> pa.Array:
        return bands(column)

    docs = docs.select("doc_id", "text")
    rows = written(docs.select("doc_id", _key("text").alias("key"), banded(F.col("text")).alias("bands")), "signatures")
    nodes = written(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands")), "nodes")
    named = nodes.select("key", "doc_id").join(roots(docs, nodes, threshold), "key")
    # The text that stands for a class has its least doc_id; ids that texts share are told apart by the key.
    best = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("b"))
    return rows.select("doc_id", "key"), written(named.join(best, "root").select("key", F.col("b.doc_id").alias("class_id"), F.col("b.key").alias("class_key")), "classes")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id of every row."""
    rows, named = classes(docs, threshold)
    return rows.join(named, "key").select("doc_id", "class_id")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, cut down to one of each class: that of its least doc_id."""
    _, named = classes(docs, threshold)
    key = fresh("key", docs)
    of, best = fresh("of_class", docs), fresh("class_id", docs)
    kept = named.where("key = class_key").select(F.col("key").alias(of), F.col("class_id").alias(best))
    # By key and id, so that copies of one text don't meet in one task; rows that repeat both fall to dropDuplicates,
    # which finds them dealt out already.
    out = docs.withColumn(key, _key("text")).join(kept, (F.col(key) == F.col(of)) & F.col("doc_id").eqNullSafe(F.col(best)), "left_semi")
    return out.dropDuplicates([key, "doc_id"]).drop(key)
