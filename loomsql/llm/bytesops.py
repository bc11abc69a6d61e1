"""Vectorised numpy work on the UTF-8 bytes of Arrow string columns, shared by the text operators.

Words are kept as 64-bit hashes of their bytes: a random-table polynomial over prefix sums, so that one pass over a
slice hashes every word (or any substring) without a Python loop. Two different words share a hash with a probability
of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once. A longer single text makes a slice of its own.
SLICE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers; x isn't changed."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        _powers[:] = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    found = _powers[0][:n], _powers[1][:n]
    if len(_powers[0]) > 8 * SLICE_BYTES:  # made for one very long text
        _powers[:] = []
    return found


def forget() -> None:
    """Give the powers' memory back, where a worker goes on to steps without texts."""
    _powers[:] = []


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large_string array in which a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array without nulls, and the n + 1 offsets into them."""
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(array: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of pieces of at most so many bytes, or of one row."""
    if not len(array):
        return
    _, offsets = buffers(array)
    start = 0
    while start < len(array):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, array.slice(start, end - start)
        start = end


def separated(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Like buffers(), with a space after each text, so that no word reaches into the next one."""
    return buffers(pc.binary_join_element_wise(array, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())))


def lowered(data: np.ndarray) -> np.ndarray:
    """With A-Z in lower case; other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


#: Bytes that aren't white space: [^\x20\x09-\x0D].
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F].
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False


def spans(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the table holds."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = table[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """n + 1 sums from which hashed() takes the hash of any substring."""
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_TABLE[data] * powers(len(data))[0], out=sums[1:])
    return sums


def hashed(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end)."""
    with np.errstate(over="ignore"):
        h = (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds of each text's words: word i of text t for bounds[t] <= i < bounds[t + 1]."""
    return np.searchsorted(starts, offsets)


def sums_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; 0 for a row without any."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
