"""Subword text classifier: hashed word and character n-gram vectors, averaged per document, into a linear softmax.

All vectors and the softmax are trained together by stochastic gradient descent (Adagrad steps) in numpy, in one task on
an executor, on a sample of labelled texts whose rows and bytes are parameters of the caller. Executors score whole
texts: for scoring, each n-gram's vector is folded with the softmax into one number, so that a model is a table of
`buckets` floats.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from . import bytesops as bo


#: Bytes of text that are scored at once, and that are cut into n-grams at once in training: n-grams take some hundred
#: times as much memory.
SCORED_BYTES, FITTED_BYTES = 512 << 10, 128 << 10


@dataclass(frozen=True)
class Config:
    """mean_of_words: a word's vector is the mean of its subwords' and a text's the mean of its words';
    otherwise a text's vector is the mean of all its words' and n-grams' vectors."""

    buckets: int = 1 << 17
    dim: int = 8
    shortest: int = 3
    longest: int = 6
    lower: bool = True
    alnum: bool = True
    mean_of_words: bool = True
    epochs: int = 8
    batch: int = 32
    rate: float = 0.3
    seed: int = 7


@dataclass
class Model:
    config: Config
    #: Per bucket, the log-odds that it adds; the mean over a text plus the bias is the text's log-odds.
    weight: np.ndarray
    bias: float
    fitted_rows: int = 0
    extra: dict = field(default_factory=dict)


class Words:
    """The distinct words of a slice of texts: their subwords' buckets, and which words each text has."""

    def __init__(self, array: pa.Array, c: Config):
        data, offsets = bo.separated(array)
        if c.lower:
            data = bo.lowered(data)
        starts, ends = bo.spans(data, bo.ALNUM if c.alnum else bo.NOT_SPACE)
        self.bounds = bo.rows_of(starts, offsets)
        keys = bo.hashed(bo.prefix_sums(data), starts, ends)
        self.keys, first, self.of = np.unique(keys, return_index=True, return_inverse=True)
        self._subwords(data, starts[first], ends[first], c)
        self._repeats(c)

    def _repeats(self, c: Config) -> None:
        """A word that follows itself becomes one word of its own, the same for all: else a text that says one word
        over and over would be judged by that word alone, and no vector would stand for the repetition."""
        n, again = len(self.keys), np.zeros(len(self.of), bool)
        again[1:] = self.of[1:] == self.of[:-1]
        again[self.bounds[:-1][self.bounds[:-1] < len(again)]] = False
        self.of[again] = n
        self.keys = np.append(self.keys, np.uint64(0))
        self.word, self.buckets = np.append(self.word, n), np.append(self.buckets, np.int32(0))
        self.sizes = np.append(self.sizes, 1)

    def _subwords(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, c: Config) -> None:
        """buckets: of all subwords; word: whose they are, ascending; a word itself counts as one of its subwords."""
        n, lengths = len(starts), ends - starts + 2  # with a mark on either side
        at = np.concatenate(([0], np.cumsum(lengths)))
        marked = np.empty(at[-1], np.uint8)
        marked[at[:-1]], marked[at[1:] - 1] = 2, 3
        inner = np.repeat(starts - at[:-1] - 1, lengths - 2) + _ranges(at[:-1] + 1, lengths - 2)
        marked[_ranges(at[:-1] + 1, lengths - 2)] = data[inner]
        sums = bo.prefix_sums(marked)
        chars = np.flatnonzero((marked & 0xC0) != 0x80)  # first bytes of code points
        ends_of_words = np.searchsorted(chars, at[1:])  # by number of the code point
        word = np.repeat(np.arange(n), np.diff(np.concatenate(([0], ends_of_words))))
        chars = np.append(chars, len(marked))
        where, what = [np.arange(n)], [self.keys % np.uint64(c.buckets)]
        i = np.arange(len(word))
        for size in range(c.shortest, c.longest + 1):
            ok = i[i + size <= ends_of_words[word]]
            where.append(word[ok])
            what.append(bo.hashed(sums, chars[ok], chars[ok + size]) % np.uint64(c.buckets))
        where, what = np.concatenate(where), np.concatenate(what).astype(np.int32)
        order = np.argsort(where, kind="stable")
        self.word, self.buckets = where[order], what[order]
        self.sizes = np.bincount(where, minlength=n)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] numbers, then the same for the next."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _expit(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def score(model: Model, column: pa.Array) -> np.ndarray:
    """Probability of label 1 for each whole text. A text without words gets what the bias says."""
    c, array = model.config, bo.texts(column)
    out = np.empty(len(array))
    for row, part in bo.slices(array, SCORED_BYTES):
        w = Words(part, c)
        total = np.bincount(w.word, model.weight[w.buckets], len(w.keys))
        if c.mean_of_words:
            mean = bo.sums_by_row((total / w.sizes)[w.of], w.bounds) / np.maximum(np.diff(w.bounds), 1)
        else:
            mean = bo.sums_by_row(total[w.of], w.bounds) / np.maximum(bo.sums_by_row(w.sizes[w.of], w.bounds), 1)
        out[row : row + len(part)] = _expit(mean + model.bias)
    return out


class Sample:
    """Training texts as numbers of words; the subwords of each different word are kept once, whatever number of texts
    has it. So a sample takes about eight bytes for each different word of each text, and four for each subword of each
    different word."""

    def __init__(self, c: Config):
        self.config, self.bounds = c, [0]
        #: By number of the word: its subwords' bounds and buckets.
        self.first, self.buckets = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self._keys, self._numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._words, self._weights = [], []

    def add(self, column: pa.Array) -> None:
        for _, part in bo.slices(bo.texts(column), FITTED_BYTES):
            w = Words(part, self.config)
            number = self._numbered(w)
            counts = np.diff(w.bounds)
            whole = counts if self.config.mean_of_words else bo.sums_by_row(w.sizes[w.of], w.bounds)
            pair, times = np.unique(np.repeat(np.arange(len(part)), counts) * len(w.keys) + w.of, return_counts=True)
            doc, word = pair // len(w.keys), pair % len(w.keys)
            self._words.append(number[word].astype(np.int32))
            self._weights.append((times / np.maximum(whole, 1)[doc]).astype(np.float32))
            self.bounds += (self.bounds[-1] + np.cumsum(np.bincount(doc, minlength=len(part)))).tolist()

    def _numbered(self, w: Words) -> np.ndarray:
        """The numbers of a slice's words; what is new gets the next ones."""
        at = np.searchsorted(self._keys, w.keys)
        known = at < len(self._keys)
        known[known] = self._keys[at[known]] == w.keys[known]
        new, total = np.flatnonzero(~known), len(self.first) - 1
        number = np.empty(len(w.keys), np.int64)
        number[known], number[new] = self._numbers[at[known]], total + np.arange(len(new))
        first = np.concatenate(([0], np.cumsum(w.sizes)))
        self.buckets = np.concatenate((self.buckets, w.buckets[_ranges(first[new], w.sizes[new])]))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(w.sizes[new])))
        keys, numbers = np.concatenate((self._keys, w.keys[new])), np.concatenate((self._numbers, number[new]))
        order = np.argsort(keys)
        self._keys, self._numbers = keys[order], numbers[order]
        return number

    def done(self) -> Sample:
        """words, weights: of each text, its different words and the share that a word's vector has in the text's."""
        self.words = np.concatenate(self._words or [np.zeros(0, np.int32)])
        self.weights = np.concatenate(self._weights or [np.zeros(0, np.float32)])
        self.starts = np.array(self.bounds, np.int64)
        self._words = self._weights = self._keys = self._numbers = None
        return self


class Batch:
    """Some texts of a sample: their entries, different words and these words' subwords."""

    def __init__(self, s: Sample, rows: np.ndarray):
        sizes = s.starts[rows + 1] - s.starts[rows]
        at = _ranges(s.starts[rows], sizes)
        self.n, self.doc, self.weights = len(rows), np.repeat(np.arange(len(rows)), sizes), s.weights[at]
        words, self.word = np.unique(s.words[at], return_inverse=True)
        self.sizes = s.first[words + 1] - s.first[words]
        self.buckets = s.buckets[_ranges(s.first[words], self.sizes)]
        self.ends = np.cumsum(self.sizes)
        #: A word's vector is the mean or the sum of its subwords'.
        self.scale = 1 / self.sizes if s.config.mean_of_words else np.ones(len(words))

    def hidden(self, vectors: np.ndarray) -> np.ndarray:
        """The texts' vectors."""
        out = np.zeros((self.n, vectors.shape[1]))
        if len(self.word):
            word = np.add.reduceat(np.take(vectors, self.buckets, axis=0), self.ends - self.sizes, axis=0) * self.scale[:, None]
            for d in range(out.shape[1]):
                out[:, d] = np.bincount(self.doc, self.weights * word[self.word, d], self.n)
        return out

    def gradient(self, error: np.ndarray, buckets: int) -> np.ndarray:
        """Of each bucket, the sum of the texts' errors by its share in their vectors."""
        word = np.bincount(self.word, self.weights * error[self.doc], len(self.sizes)) * self.scale
        return np.bincount(self.buckets, np.repeat(word, self.sizes), buckets).astype(np.float32)


def fit(column: pa.Array, labels: np.ndarray, c: Config, prior: float | None = None) -> Model:
    """Train on whole texts. prior: the share of label 1 among all rows, where the sample has been drawn by class."""
    sample = Sample(c)
    sample.add(column)
    return train(sample.done(), labels, prior)


def train(sample: Sample, labels: np.ndarray, prior: float | None = None) -> Model:
    """Stochastic gradient descent (Adagrad steps) over all vectors and the softmax together."""
    c, y = sample.config, np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():  # nothing to tell apart
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model(c, np.zeros(c.buckets, np.float32), float(np.log(share / (1 - share))), len(y))
    rng = np.random.default_rng(c.seed)
    vectors = np.ascontiguousarray(rng.normal(0, 0.1, (c.dim, c.buckets)).astype(np.float32).T)
    # Of a two-class softmax only the difference of the classes' rows matters.
    out, bias = np.linspace(-1, 1, c.dim).astype(np.float32), 0.0
    seen, seen_out, seen_bias = np.full((c.buckets, c.dim), 1e-10, np.float32), np.full(c.dim, 1e-10, np.float32), 1e-10
    even = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    steps, step = c.epochs * -(-len(y) // c.batch), 0
    for _ in range(c.epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), c.batch):
            rows = order[k : k + c.batch]
            rate = np.float32(c.rate * (1 - 0.9 * step / steps))
            step += 1
            batch = Batch(sample, rows)
            hidden = batch.hidden(vectors)
            error = (_expit(hidden @ out + bias) - y[rows]) * even[rows] / len(rows)
            g_out, g_bias = error @ hidden, error.sum()
            # A bucket's gradient is this sum times the softmax's weight of the dimension.
            g = batch.gradient(error, c.buckets)
            touched = np.flatnonzero(g)
            move = g[touched, None] * out
            sums = np.take(seen, touched, axis=0) + move * move
            seen[touched] = sums
            vectors[touched] -= rate * move / np.sqrt(sums)
            seen_out += g_out * g_out
            seen_bias += g_bias * g_bias
            out -= rate * g_out / np.sqrt(seen_out)
            bias -= rate * g_bias / np.sqrt(seen_bias)
    if prior is not None:
        bias += np.log(np.clip(prior, 1e-3, 1 - 1e-3) / (1 - np.clip(prior, 1e-3, 1 - 1e-3)))
    return Model(c, (vectors @ out).astype(np.float32), float(bias), len(y))
