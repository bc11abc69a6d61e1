"""The classifiers' numpy against slow versions: scores word by word, gradients by differences."""

import re

import numpy as np
import pyarrow as pa
import pytest

from loomsql.llm import bytesops as bo
from loomsql.llm import quality, subword, toxicity

TEXTS = ["Bad bad BAD wörds here", "", None, "a", "nice, Nice words; here and hereafter", "éé éé éé ab", "x " * 40 + "end", "one two three four five six"]
CONFIGS = [toxicity.CONFIG, quality.CONFIG]


def bucket(data: bytes, c):
    array = np.frombuffer(data, np.uint8)
    return int(bo.hashed(bo.prefix_sums(array), np.array([0]), np.array([len(data)]))[0] % np.uint64(c.buckets))


def words_of(text, c):
    text = text or ""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text) if c.lower else text
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+" if c.alnum else r"[^\x20\x09-\x0D]+", text)


def subwords(text, c):
    """For each word its buckets; a word that follows itself has the one of repetition."""
    out, before = [], None
    for word in words_of(text, c):
        marked, found = f"\x02{word}\x03", [bucket(word.encode(), c)]
        for size in range(c.shortest, c.longest + 1):
            found += [bucket(marked[k : k + size].encode(), c) for k in range(len(marked) - size + 1)]
        out.append([0] if word == before else found)
        before = word
    return out


def share(text, c):
    """Of each bucket its share in the text's vector."""
    words, out = subwords(text, c), {}
    for w in words:
        for b in w:
            out[b] = out.get(b, 0) + (1 / len(w) / len(words) if c.mean_of_words else 1 / sum(map(len, words)))
    return out


@pytest.mark.parametrize("c", CONFIGS)
def test_scores_word_by_word(c):
    rng = np.random.default_rng(1)
    model = subword.Model(c, rng.normal(0, 3, c.buckets).astype(np.float32), -0.3)
    got = subword.score(model, pa.array(TEXTS))
    for text, p in zip(TEXTS, got, strict=True):
        assert p == pytest.approx(1 / (1 + np.exp(0.3 - sum(model.weight[b] * s for b, s in share(text, c).items()))), abs=1e-6)


@pytest.mark.parametrize("c", CONFIGS)
def test_a_batch_is_what_its_texts_are(c):
    sample = subword.Sample(c)
    sample.add(pa.array(TEXTS[:3]))
    sample.add(pa.array(TEXTS[3:]))
    sample.done()
    rows, rng = np.array([7, 0, 5, 1, 6, 4]), np.random.default_rng(2)
    vectors, error = rng.normal(0, 1, (c.buckets, 3)).astype(np.float32), rng.normal(0, 1, len(rows))
    batch = subword.Batch(sample, rows)
    shares = [share(TEXTS[r], c) for r in rows]
    want = [[sum(s * vectors[b, d] for b, s in own.items()) for d in range(3)] for own in shares]
    assert batch.hidden(vectors) == pytest.approx(np.array(want), abs=1e-5)
    g = batch.gradient(error, c.buckets)
    for b in {b for own in shares for b in own}:
        assert g[b] == pytest.approx(sum(e * own.get(b, 0) for e, own in zip(error, shares, strict=True)), abs=1e-5)
    assert np.count_nonzero(g) == len({b for own in shares for b in own})


def test_gradient_by_differences():
    """Of the loss of a batch by a bucket's vector: what a step moves by is the batch's gradient times the softmax."""
    c = toxicity.CONFIG
    sample = subword.Sample(c)
    sample.add(pa.array(TEXTS))
    sample.done()
    rng, rows, y = np.random.default_rng(3), np.arange(len(TEXTS)), np.array([1, 0, 0, 1, 0, 1, 1, 0])
    vectors, out = rng.normal(0, 0.5, (c.buckets, c.dim)), rng.normal(0, 1, c.dim)
    batch = subword.Batch(sample, rows)

    def loss(v):
        p = 1 / (1 + np.exp(-(batch.hidden(v) @ out)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    g = batch.gradient(1 / (1 + np.exp(-(batch.hidden(vectors) @ out))) - y, c.buckets)
    for b in rng.choice(np.flatnonzero(g), 8, replace=False):
        for d in range(c.dim):
            step = np.zeros_like(vectors)
            step[b, d] = 1e-4
            assert (loss(vectors + step) - loss(vectors - step)) / 2e-4 == pytest.approx(g[b] * out[d], abs=2e-4)


def test_unseen_misspellings_are_near_their_stem():
    rng = np.random.default_rng(4)
    clean = [" ".join(f"word{k}" for k in rng.integers(0, 60, 12)) for _ in range(120)]
    texts = [t + (" horribleness" if i % 2 else " gentleness") for i, t in enumerate(clean)]
    model = subword.fit(pa.array(texts), np.arange(120) % 2, toxicity.CONFIG)
    seen, twisted, other = subword.score(model, pa.array(["word1 horribleness", "word1 horriblenezz", "word1 gentlenezz"]))
    assert seen > 0.5 and twisted > 0.5 > other
