"""The n-gram model against a slow one over dictionaries, and the sequences and tries under it."""

import math
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomsql.llm import lm
from loomsql.llm.eliasfano import EliasFano, Trie

DATA = "/root/testdata/sf0.001"


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), "\n"]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


def slow(rows, order, exact=False):
    """(n_tokens, n_known, N, base, score) of each (id, text). exact: no probability is quantised."""
    counts, seen = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]

    def grams(words, k):
        return [(("<",) + tuple(words[max(0, i - k + 1) : i]))[-(k - 1) :] + (words[i],) if i < k - 1 else tuple(words[i - k + 1 : i + 1]) for i in range(len(words))] if k > 1 else [(w,) for w in words]

    for i, text in rows:
        if not held(i):
            for k in range(1, order + 1):
                for g in grams(tokens(text), k):
                    counts[k][g] += 1
                    seen[k][g[:-1]] += 1
    n, v = sum(counts[1].values()), len(counts[1])

    def step(p):
        return p if exact else 10 ** (-min(65534, round(-math.log10(p) * lm.STEPS)) / lm.STEPS)

    def low(p):
        return p if exact else math.exp(-min(255, round(-math.log(p) * lm.LOW_STEPS)) / lm.LOW_STEPS)

    def probability(gs, k):
        if k == 1:
            return (counts[1][gs[0]] + 0.1) / (n + 0.1 * (v + 1))
        g, shorter = gs[k - 1], probability(gs, k - 1)
        c = seen[k][g[:-1]]
        a, e = lm.LEFT[min(k, max(lm.LEFT))]
        m = a * c**-e if c else 1.0
        return step(min(1.0, (1 - m) * counts[k][g] / c + m * low(shorter))) if counts[k][g] else m * shorter

    out = []
    for i, text in rows:
        words = tokens(text)
        of = list(zip(*[grams(words, k) for k in range(1, order + 1)], strict=True))
        out.append((i, held(i), len(words), sum(counts[1][(w,)] > 0 for w in words), n, sum(math.log10(probability(gs, 1)) for gs in of), sum(math.log10(probability(gs, order)) for gs in of)))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0, row[2], round(row[6], 4))


def scores(docs, **k):
    return [tuple(r[n] for n in lm.SCORES.names) for r in lm.score_lm(docs, **k).collect()]


LONG = " ".join(f"wörd{i * i % 977}" for i in range(9000))
ODD = [(1, None), (2, ""), (3, LONG), (4, "same Words here again and again"), (4, "same words here again and again"), (4, "other"), (None, "x x x x x x"), (11, "x x x x x y"), (12, "same words \t here\n"), *[(100 + i, f"the {'ab'[i % 2]} the {i % 5} of the") for i in range(90)]]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("sizes", [{}, {"block_tokens": 300, "shard_tokens": 200, "salt_tokens": 20}])
def test_scores_against_brute_force(spark, order, sizes):
    docs = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, tokens string").repartition(3)
    got, want = sorted(scores(docs, order=order, **sizes), key=key), sorted(slow(ODD, order), key=key)
    for one, two in zip(got, want, strict=True):
        assert one[:5] == two[:5] and one[5:] == pytest.approx(two[5:], rel=1e-9, abs=1e-6)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r[0]: r for r in scores(docs, block_tokens=20_000, shard_tokens=10_000, salt_tokens=500)}
    exact = {r[0]: r for r in slow(rows, 3, exact=True)}
    for r in slow(rows, 3):
        assert got[r[0]][:5] == r[:5] and got[r[0]][5:] == pytest.approx(r[5:], abs=1e-5)
        assert got[r[0]][6] == pytest.approx(exact[r[0]][6], abs=0.01 * r[2])  # of an exact model, 0.01 a token


def test_longer_contexts_fit_held_out_rows_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    of = {k: [r for r in scores(docs, order=k) if r[1]] for k in (2, 3)}
    base, two, three = sum(r[5] for r in of[2]), sum(r[6] for r in of[2]), sum(r[6] for r in of[3])
    n = sum(r[2] for r in of[2])
    assert base / n < two / n - 0.3 < three / n - 0.3


def test_probabilities_after_a_context_sum_to_one():
    """Of words that were seen after it and those that weren't, as a trie's steps allow."""
    rng = np.random.default_rng(1)
    for c in (1, 7, 1000, 10**6):
        n = np.bincount(rng.integers(0, 40, c), minlength=60)
        low = rng.random(60)
        low /= low.sum()
        m = lm.left(2, np.array([c]))[0]
        exact = (1 - m) * n / c + m * low
        stored = np.where(n > 0, lm.decoded(lm.coded(np.minimum(1, (1 - m) * n / c + m * lm._low_decoded(lm._low_coded(low))))), m * low)
        assert exact.sum() == pytest.approx(1) and stored.sum() == pytest.approx(1, abs=0.03) and stored.max() <= 1


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert scores(docs) == []
    only = [i for i in range(100) if held(i)][:2]  # nothing to learn from
    assert [r[2:] for r in scores(spark.createDataFrame([(i, "a b") for i in only], docs.schema))] == [(3, 0, 0, 0.0, 0.0)] * 2


def test_a_frequent_pair_is_counted_exactly(spark):
    docs = spark.range(1, 1191).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text"))
    rows = [(i, "x y") for i in range(1, 1191)]
    want = slow(rows[:1], 1)[0][:1]
    for size in (700, 10**6):
        got = scores(docs, block_tokens=size, shard_tokens=size, salt_tokens=100)
        assert len({round(r[6], 9) for r in got}) == 1 and want
        assert got[0][6] == pytest.approx(slow(rows, 3)[0][6], abs=1e-6)


def test_sequences_against_sorted_arrays():
    rng = np.random.default_rng(2)
    for n, universe in ((0, 10), (1, 2**63 - 1), (5, 7), (1000, 1 << 48), (1000, 50), (3, 1 << 60), (4000, 1 << 41)):
        values = np.sort(rng.integers(0, universe, n))
        e = EliasFano(*EliasFano.arrays(values, universe))
        asked = np.concatenate((values, rng.integers(0, universe, 50), values[:-1] + 1, [0]))
        assert (e.get(np.arange(n)) == values).all() and (not n or (e.successor(asked) == np.searchsorted(values, asked)).all())


def test_trie_against_a_dictionary():
    rng = np.random.default_rng(3)
    grams = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 300, 4000) << 30, rng.integers(0, 2**32, 4000), strict=True)})
    codes = rng.integers(1, 65536, len(grams)).astype(np.uint16)
    trie = Trie.build(np.array([a for a, _ in grams]), np.array([b for _, b in grams], np.uint32), codes, 1 << 48)
    want = dict(zip(grams, codes.tolist(), strict=True))
    contexts = [k << 30 for k in range(-1 + 1, 310)] + [17, (5 << 30) + 1]
    asked = [sorted({b for a, b in grams if a == c} | {int(x) for x in rng.integers(0, 2**32, 3)}) for c in contexts]
    got = trie.lookup(np.array(contexts), np.array([len(a) for a in asked]), np.array(sum(asked, []), np.uint32))
    assert got.tolist() == [want.get((c, b), 0) for c, a in zip(contexts, asked, strict=True) for b in a]
    none = Trie.build(np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint16), 1 << 48)
    assert none.lookup(np.array([3]), np.array([1]), np.array([4], np.uint32)).tolist() == [0]


def test_distinct_numbers_and_packed_bytes():
    rng = np.random.default_rng(8)
    for kind, top in ((np.int64, 50), (np.int64, 1 << 62), (np.uint64, 1 << 40), (np.uint64, (1 << 64) - 1)):
        for n in (0, 1, 2, 255, 256, 3000):
            numbers = rng.integers(0, top, n, dtype=kind)
            numbers[n // 2 :] = numbers[: n - n // 2]
            numbers[:1] = np.iinfo(kind).min if top == 1 << 62 and n == 3000 else numbers[:1]
            values, of = lm.distinct(numbers)
            want = np.unique(numbers)
            assert values.dtype == kind and values.tolist() == want.tolist() and (values[of] == numbers).all()
    for k in (2, 3, 4, 6, 8):
        numbers = rng.integers(0, 1 << (8 * k - 1), 500)
        assert lm._numbers(lm._planes(numbers, k), k).tolist() == lm._grown(lm._shrunk(numbers, k), k).tolist() == numbers.tolist()
    assert lm._grown(lm._shrunk(np.zeros(0, np.int64))).tolist() == []


def test_cpu_of_messages():
    counts = np.minimum(np.random.default_rng(9).zipf(1.3, 1_000_000), 10**6).astype(np.int64)
    took = {}
    for name, f in (("ours", lambda: lm._grown(lm._shrunk(counts))), ("zlib", lambda: zlib.compress(lm._planes(counts, 4), 1))):
        f()
        start = time.process_time()
        for _ in range(3):
            f()
        took[name] = time.process_time() - start
    assert took["ours"] < took["zlib"]


def test_search_finds_what_is_there():
    rng = np.random.default_rng(10)
    for n, top in ((0, 5), (1, 1), (40, 60), (300, 1 << 20), (300, 1 << 50), (2000, 2001)):
        values = np.sort(rng.integers(0, top, n))
        count, low_bits, low, high = EliasFano.arrays(values, top)
        sequence = EliasFano(count, low_bits, low, high)
        x = np.concatenate((rng.integers(0, top, 200), values, np.maximum(values - 1, 0), [0, top - 1]))
        first, end = np.sort(rng.integers(0, n + 1, (2, len(x))), axis=0)
        place, found = sequence.search(x, first, end)
        assert place.tolist() == [a + int(np.searchsorted(values[a:b], y)) for y, a, b in zip(x, first, end, strict=True)]
        assert found.tolist() == [y in values[a:b] for y, a, b in zip(x, first, end, strict=True)]


def stepped(monkeypatch, rows, shards, salt_tokens):
    """All steps in this process, one block: scores, the most bytes that each step had at once, the sender's batches."""
    monkeypatch.setattr("pyspark.TaskContext", type("Context", (), {"get": classmethod(lambda c: c), "partitionId": staticmethod(lambda: 0)}))
    peaks, batches = {}, []

    def traced(name, f):
        tracemalloc.start()
        out = f()
        peaks[name] = max(peaks.get(name, 0), tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        return out

    def size(table):
        return table.append_column("n", [[sum(len(x) for x in r.values() if isinstance(x, bytes)) for r in table.to_pylist()]])

    [block] = lm._blocks(iter([pa.record_batch({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})]), 10**9)
    tokens, docs, types = block["n_train"][0].as_py(), block["n_docs"][0].as_py(), 0
    block = pa.Table.from_batches([block])
    for k in (1, 2, 3):
        numbers = (tokens, types, docs, salt_tokens)
        for f in traced(f"send {k}", lambda: [pa.Table.from_batches([b]) for b in lm._sent(iter(block.to_batches()), numbers, shards)]):
            batches.append((k, size(f)))
        sent = pa.concat_tables([b.drop(["n"]) for o, b in batches if o == k])
        answers = [traced(f"answer {k}", lambda s=s: lm._answerer(k, k == 3)(sent.filter(pa.compute.equal(sent["shard"], s)))) for s in range(shards)]
        types = types or sum(sum(a["types"].to_pylist()) for a in answers)
        answers, numbers = pa.concat_tables(answers), (tokens, types, docs, salt_tokens)
        block = traced(f"merge {k}", lambda: (lm._scorer(numbers, 3) if k == 3 else lm._merger(numbers))(block, answers))
    return [tuple(r.values()) for r in block.to_pylist()], peaks, batches


@pytest.fixture
def large():
    rng = np.random.default_rng(11)
    return [(i, " ".join(f"w{x}" for x in np.minimum(rng.zipf(1.2, 2000), 50_000))) for i in range(150)]


def test_memory_of_a_block(monkeypatch, large):
    """Of a task's steps over one block, in bytes a token; the messages go out in small batches."""
    got, peaks, batches = stepped(monkeypatch, large, 8, 5000)
    tokens = sum(r[2] for r in got)
    assert max(peaks.values()) < 80 * tokens
    for _, b in batches:
        assert sum(b["n"].to_pylist()[:-1]) < lm.BATCH_BYTES  # the last one fills it
    assert sum(k == 3 for k, _ in batches) > 1
    for one, two in zip(got, slow(large, 3), strict=True):
        assert one[:5] == two[:5] and one[5:] == pytest.approx(two[5:], rel=1e-3)  # of many words after a frequent pair two may share 24 bits
