"""Elias-Fano sequences and a two-level n-gram trie of them, with vectorised lookups.

A sequence of n ascending integers below u keeps the low l = log2(u / n) bits of each in a packed array and the high
bits as a unary bit vector: about 2 + l bits each. All arrays of a trie lie one after the other in one memory map.
"""

from __future__ import annotations

import mmap

import numpy as np

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: By byte and k: the place of its k-th one.
_PLACE = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _p in enumerate([i for i in range(8) if _b >> i & 1]):
        _PLACE[_b, _k] = _p
#: Low bits of a value at most, so that values stay whole in 64-bit words.
_MOST_LOW = 56


class EliasFano:
    """n ascending integers (equal ones allowed) below 2 ** 63."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.l, self.low, self.high = n, low_bits, low, high
        #: Ones and zeros before each byte of the bit vector.
        self.ones = np.concatenate(([0], np.cumsum(_POPCOUNT[high].astype(np.int64))))
        self.zeros = np.arange(len(high) + 1) * 8 - self.ones

    @classmethod
    def arrays(cls, values: np.ndarray, universe: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """n, low bits, and the two arrays: 64-bit words and bytes."""
        n = len(values)
        low_bits = min(_MOST_LOW, max(0, int(universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        bit = np.arange(n) * low_bits
        words, shift = bit >> 6, (bit & 63).astype(np.uint64)
        packed = np.zeros((n * low_bits >> 6) + 2, np.uint64)
        if low_bits and n:
            low = values & np.uint64((1 << low_bits) - 1)
            # Of each word, what begins in it; then what the last of these leaves for the next word.
            at = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
            packed[words[at]] = np.bitwise_or.reduceat(low << shift, at)
            over = np.flatnonzero(shift.astype(np.int64) + low_bits > 64)
            packed[words[over] + 1] |= low[over] >> (np.uint64(64) - shift[over])
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 2 if n else 1, np.uint8)
        bits[at] = 1
        return n, low_bits, packed, np.packbits(bits, bitorder="little")

    def _select(self, k: np.ndarray, counts: np.ndarray, flip: int) -> np.ndarray:
        byte = np.searchsorted(counts, k, "right") - 1
        inside = self.high[np.minimum(byte, len(self.high) - 1)] ^ np.uint8(flip)
        return byte * 8 + _PLACE[inside, np.minimum(k - counts[byte], 7)]

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        high = self._select(i, self.ones, 0) - i
        return (high << self.l) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.int64)
        bit = i * self.l
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        out = self.low[word] >> shift
        # A shift by 64 places is none; so it is made in two steps.
        out |= self.low[word + 1] << (np.uint64(63) - shift) << np.uint64(1)
        return (out & np.uint64((1 << self.l) - 1)).astype(np.int64)

    def successor(self, x: np.ndarray, first: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Index of the least value >= x among those with first <= index < end (or end, if there is none)."""
        return self.search(x, first, end)[0]

    def search(self, x: np.ndarray, first: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """successor(), and whether it is x itself."""
        x = np.asarray(x, np.int64)
        end = np.broadcast_to(self.n if end is None else end, x.shape)
        bucket = x >> self.l
        # Values whose high part is the bucket lie between two zeros of the bit vector.
        total = int(self.zeros[-1])
        lo = np.where(bucket > 0, self._select(np.minimum(np.maximum(bucket - 1, 0), total - 1), self.zeros, 255) - bucket + 1, 0)
        hi = np.where(bucket < total, self._select(np.minimum(bucket, total - 1), self.zeros, 255) - bucket, self.n)
        lo = np.where(bucket - 1 >= total, self.n, lo)
        lo, hi = np.clip(lo, first, end), np.clip(np.minimum(hi, self.n), first, end)
        low, last = x & ((1 << self.l) - 1), hi.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        # What lies before the bucket's end has x's high part.
        found = lo < last
        at = np.flatnonzero(found)
        found[at] = self._low(lo[at]) == low[at]
        return lo, found


class Trie:
    """Contexts, and under each its successors with a code (0 is no code).

    Level 1: the sorted contexts, with monotone pointers to their successors. Level 2: the successors below 2 ** 32, made
    ascending over all contexts by adding the context's number times 2 ** 32, so that a lookup is a successor search
    within the context's range.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray, codes: np.ndarray, universe: int) -> Trie:
        """first: contexts below the universe; second: successors; sorted by (first, second), without repeats. All levels
        are laid out in one anonymous memory map."""
        at = np.flatnonzero(np.append(True, first[1:] != first[:-1])) if len(first) else np.zeros(0, np.int64)
        start = np.append(at, len(first))
        number = np.repeat(np.arange(len(at)), np.diff(start))
        parts = [
            EliasFano.arrays(first[at], universe),
            EliasFano.arrays(start, len(first) + 1),
            EliasFano.arrays(number << 32 | second.astype(np.int64), max(len(at), 1) << 32),
        ]
        arrays = [x for p in parts for x in p[2:]] + [codes]
        room = [-(-a.nbytes // 8) * 8 for a in arrays]  # each begins at a multiple of eight
        buffer = np.frombuffer(mmap.mmap(-1, max(sum(room), 1)), np.uint8)
        laid, place = [], 0
        for a, r in zip(arrays, room, strict=True):
            laid.append(buffer[place : place + a.nbytes].view(a.dtype))
            laid[-1][:] = a
            place += r
        return cls(*[EliasFano(p[0], p[1], laid[2 * k], laid[2 * k + 1]) for k, p in enumerate(parts)], laid[-1])

    def lookup(self, contexts: np.ndarray, sizes: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The codes of n-grams, 0 for one that the trie doesn't have. sizes: how many of the second words each context
        has."""
        out = np.zeros(len(second), self.codes.dtype)
        if not self.contexts.n or not len(second):
            return out
        contexts = contexts.astype(np.int64)
        c, known = self.contexts.search(contexts)
        c = np.where(known, c, 0)
        low, high, c = (np.repeat(x, sizes) for x in (self.pointers.get(c), self.pointers.get(c + 1), c))
        at = np.flatnonzero(np.repeat(known, sizes))
        x = c[at] << 32 | second[at].astype(np.int64)
        i, hit = self.successors.search(x, low[at], high[at])
        out[at[hit]] = self.codes[i[hit]]
        return out
