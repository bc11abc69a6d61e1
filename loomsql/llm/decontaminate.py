"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised benchmark items.

Normalised: A-Z lower-cased, words are runs of letters, digits and non-ASCII characters. A window is WINDOW
consecutive words of an item; an item of fewer words, but not none, is one window. Each text is scanned once, and what
is found is mapped back to word numbers and to code-point offsets of the original text.

The one automaton is broadcast only up to MOST_BYTES of benchmark text. Of a larger benchmark the windows are a table,
joined by their hashes with the texts' windows of the same lengths, of which a bitmap of fixed size has let through those
that some item may have; then each text that has found any is scanned once, by the automaton of the windows that it may
hold. Both ways give the same rows.

Defined results: a null or empty text has no words and no hits; texts of any length are scanned whole; items without
words match nothing; items with equal windows are all reported; rows of equal texts get equal results; a null item id
takes no part; an empty table gives no rows, an empty benchmark no hits; extra columns of either table play no part, and
stay in what decontaminate() gives, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import bytesops as bo
from .scratch import fresh, written
from .subword import _ranges

WINDOW = 10
#: Benchmark text that one broadcast automaton is built of at most: its nodes take a few hundred times as much memory.
MOST_BYTES = 256 << 10
#: Bits of the bitmap over a larger benchmark's windows, and of each of its pieces.
BITS, PIECE = 1 << 26, 1 << 15

SPAN = StructType([StructField("item_id", LongType()), StructField("first_word", LongType()), StructField("n_words", LongType()), StructField("start", LongType()), StructField("end", LongType())])
FOUND = StructType([StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()), StructField("items_sha256", StringType()), StructField("spans", ArrayType(SPAN))])
_automata: dict = {}


def words_of(text: str | None) -> list[str]:
    """A text's normalised words."""
    data = bo.lowered(np.frombuffer((text or "").encode(), np.uint8))
    return [data[a:b].tobytes().decode("latin-1") for a, b in zip(*bo.spans(data, bo.ALNUM), strict=True)]


def windows(items: list[tuple[int, str | None]], size: int = WINDOW) -> dict[str, list[tuple[int, int]]]:
    """Of each window, as latin-1 text with a space around each word: (its number of words, item id) of its items."""
    found = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        for k in range(max(1, len(words) - size + 1) if words else 0):
            part = words[k : k + size]
            found[f" {' '.join(part)} "].add((len(part), item))
    return {k: sorted(v) for k, v in found.items()}


def _automaton(patterns: dict):
    made = ahocorasick.Automaton()
    for pattern, items in patterns.items():
        made.add_word(pattern, items)
    if patterns:
        made.make_automaton()
    return made


def automaton(key, patterns: dict):
    """Built once in each Python worker; only the last one is kept."""
    if key not in _automata:
        _automata.clear()
        _automata[key] = _automaton(patterns)
    return _automata[key]


def scan(column: pa.Array, found_by) -> tuple[np.ndarray, dict[int, list[tuple[int, int, int, int, int]]]]:
    """Number of words of each text; of texts with hits (item, first word, words, start, end in code points)."""
    array = bo.texts(column)
    n_words, hits = np.zeros(len(array), np.int64), {}
    for row, part in bo.slices(array):
        raw, offsets = bo.separated(part)
        data = bo.lowered(raw)
        starts, ends = bo.spans(data, bo.ALNUM)
        bounds = bo.rows_of(starts, offsets)
        counts = np.diff(bounds)
        n_words[row : row + len(part)] = counts
        if not len(found_by) or not len(starts):
            continue
        # "\n " before each text, a space after each word: no window reaches into the next text.
        size = ends - starts + 1
        doc = np.repeat(np.arange(len(part)), counts)
        out_ends = np.cumsum(size) + 2 * (doc + 1)
        stream = np.full(int(size.sum()) + 2 * len(part), 32, np.uint8)
        first = np.concatenate(([0], np.cumsum(size)))[bounds[:-1]] + 2 * np.arange(len(part))
        stream[first] = 10
        stream[_ranges(out_ends - size, size - 1)] = data[_ranges(starts, size - 1)]
        for end, items in found_by.iter(stream.tobytes().decode("latin-1")):
            last = int(np.searchsorted(out_ends, end + 1))
            d = int(doc[last])
            for n, item in items:
                k = last - n + 1
                hits.setdefault(row + d, []).append((item, k - int(bounds[d]), n, int(starts[k]) - int(offsets[d]), int(ends[last]) - int(offsets[d])))
        for d in range(row, row + len(part)):
            if d in hits:  # bytes to code points
                lead = np.concatenate(([0], np.cumsum((raw[offsets[d - row] : offsets[d - row + 1]] & 0xC0) != 0x80)))
                hits[d] = [(i, k, n, int(lead[a]), int(lead[b])) for i, k, n, a, b in hits[d]]
    return n_words, hits


def summary(n_words: int, spans: list[tuple]) -> dict:
    covered, items = set(), sorted({str(s[0]) for s in spans})
    for _, k, n, _, _ in spans:
        covered.update(range(k, k + n))
    return {"n_words": n_words, "n_hit": len(covered), "n_items": len(items), "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(), "spans": [dict(zip(SPAN.names, s, strict=True)) for s in sorted(spans)]}


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, most_bytes: int = MOST_BYTES, name: str = "found") -> DataFrame:
    """The rows with a column `name`: n_words, n_hit, n_items, items_sha256 and spans."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= most_bytes:
        return docs.withColumn(name, _finder(docs, windows([tuple(r) for r in items.collect()], size))(F.col(text)))
    key, may = fresh("text_key", docs), fresh("may_hold", docs)
    found = _held(docs.select(F.col(text).alias("text")), _windows_frame(items, size)).select(F.col("key").alias(key), F.col("held").alias(may))

    @F.arrow_udf(FOUND)
    def scanned(column: pa.Array, held: pa.Array) -> pa.Array:
        n_words, _ = scan(column, ())
        hits = {}
        for d, patterns in enumerate(held.to_pylist()):
            if patterns:
                by = defaultdict(list)
                for p in patterns:
                    by[p["pattern"]].append((p["n"], p["item"]))
                one = scan(column.slice(d, 1), _automaton(by))[1]
                hits |= {d: one[0]} if one else {}
        return _results(n_words, hits)

    keyed = docs.withColumn(key, _key(F.col(text)))
    out = keyed.join(found, key, "left").select(*[F.col(c) for c in docs.columns], F.col(may))
    return out.withColumn(name, scanned(F.col(text), F.col(may))).drop(may)


def _key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _grams(keys: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n consecutive words of a text."""
    out = np.zeros(max(len(keys) - n + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = bo.mix(out * np.uint64(0x9E3779B97F4A7C15) + keys[k : k + len(out)] + np.uint64(n))
    return out


def _word_keys(part: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of texts: lowered bytes, word starts and ends, word hashes, bounds of each text's words."""
    data, offsets = bo.separated(part)
    data = bo.lowered(data)
    starts, ends = bo.spans(data, bo.ALNUM)
    return data, starts, ends, bo.hashed(bo.prefix_sums(data), starts, ends), bo.rows_of(starts, offsets)


def _windows_frame(items: DataFrame, size: int) -> DataFrame:
    """hash, n, pattern, item of each different window of each item."""

    @F.arrow_udf("array<struct<hash:bigint,n:int,pattern:string>>")
    def cut(column: pa.Array) -> pa.Array:
        out = []
        for _, part in bo.slices(bo.texts(column)):
            data, starts, ends, keys, bounds = _word_keys(part)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                words = [data[i:j].tobytes().decode("latin-1") for i, j in zip(starts[a:b], ends[a:b], strict=True)]
                n = min(size, b - a)
                hashes = _grams(keys[a:b], n).view(np.int64).tolist() if n else []
                found = {f" {' '.join(words[k : k + n])} ": h for k, h in enumerate(hashes)}
                out.append([{"hash": h, "n": n, "pattern": p} for p, h in found.items()])
        return pa.array(out, pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int32()), ("pattern", pa.string())])))

    rows = items.select(F.col("item_id").alias("item"), F.explode(cut(F.col("text"))).alias("w"))
    return written(rows.select("w.hash", "w.n", "w.pattern", "item").distinct(), "windows")


def _bitmap(items: DataFrame) -> np.ndarray:
    """BITS bits, of which those that a window's hash falls on are set."""

    def piece(rows: pa.Table) -> pa.Table:
        bits = np.zeros(PIECE, np.uint8)
        bits[rows.column("bit").to_numpy() % PIECE] = 1
        return pa.table({"piece": rows.column("piece").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    bits = items.select(F.pmod("hash", F.lit(BITS)).alias("bit")).distinct().withColumn("piece", F.floor(F.col("bit") / PIECE))
    out = np.zeros(BITS // 8, np.uint8)
    for r in bits.groupBy("piece").applyInArrow(piece, "piece bigint, bits binary").toLocalIterator():
        out[r["piece"] * PIECE // 8 : (r["piece"] + 1) * PIECE // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _held(texts: DataFrame, items: DataFrame) -> DataFrame:
    """key, held (array of pattern, n, item): the windows whose hashes a text has, for each different text that has any."""
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # none is above the window's size
    bits = texts.sparkSession.sparkContext.broadcast(_bitmap(items))

    @F.arrow_udf("array<bigint>")
    def grams(column: pa.Array) -> pa.Array:
        out = []
        for _, part in bo.slices(bo.texts(column)):
            *_, keys, bounds = _word_keys(part)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                found = np.unique(np.concatenate([_grams(keys[a:b], n) for n in lengths] or [np.zeros(0, np.uint64)]))
                at = found & np.uint64(BITS - 1)
                set_ = bits.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                out.append(found[set_ == 1].view(np.int64).tolist())
        return pa.array(out, pa.list_(pa.int64()))

    rows = texts.select(_key(F.col("text")).alias("key"), F.explode(grams(F.col("text"))).alias("hash")).distinct()
    return rows.join(items, "hash").groupBy("key").agg(F.collect_set(F.struct("pattern", "n", "item")).alias("held"))


_SPAN_ARROW = pa.struct([(n, pa.int64()) for n in SPAN.names])
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("spans", pa.list_(_SPAN_ARROW))])


def _results(n_words: np.ndarray, hits: dict) -> pa.Array:
    n, k, none = n_words.tolist(), range(len(n_words)), hashlib.sha256(b"").hexdigest()
    rows = {d: summary(n[d], s) for d, s in hits.items()}
    return pa.StructArray.from_arrays(
        [
            pa.array(n, pa.int64()),
            pa.array([rows[d]["n_hit"] if d in rows else 0 for d in k], pa.int64()),
            pa.array([rows[d]["n_items"] if d in rows else 0 for d in k], pa.int64()),
            pa.array([rows[d]["items_sha256"] if d in rows else none for d in k], pa.string()),
            pa.array([rows[d]["spans"] if d in rows else [] for d in k], pa.list_(_SPAN_ARROW)),
        ],
        fields=list(_ARROW),
    )


def _finder(docs: DataFrame, patterns: dict):
    shared, key = docs.sparkSession.sparkContext.broadcast(patterns), uuid.uuid4().hex

    @F.arrow_udf(FOUND)
    def found(column: pa.Array) -> pa.Array:
        return _results(*scan(column, automaton(key, shared.value)))

    return found


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = find(docs.select("doc_id", "text"), benchmark, size=size)
    return found.select("doc_id", "found.n_words", "found.n_hit", "found.n_items", "found.items_sha256", (F.col("found.n_hit") > 0).alias("contaminated"))


def hit(docs: DataFrame, name: str) -> Column:
    return F.col(f"{name}.n_hit") > 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows, with all their columns, that hold no window of the benchmark."""
    name = fresh("found", docs)
    return find(docs, benchmark, size=size, name=name).where(~hit(docs, name)).drop(name)
