"""Media columns: AVI motion-JPEG in binary columns, written, parsed and cut into timed clips.

Container: RIFF/AVI with hdrl (avih, one video stream MJPG), movi (one `00dc` chunk per frame) and idx1. Frames: baseline
JPEG, 8-bit grey, 16 x 12 blocks of 8 x 8 samples, quantiser 8 for the DC term. A flat block of the sample b has the
exact DC term b - 128, so 192 payload bytes a frame are stored without loss as the samples of its 192 blocks.

The decoder reads the chunks by idx1 (or walks movi and its `rec ` lists where there is none), takes tables and size from
each frame's own headers (the usual Huffman tables where a frame has none), and decodes all frames of one kind of header
in step: each numpy operation moves every frame on by one symbol. Colour frames with one interleaved scan and restart
marks are read too; of colours only the luminance blocks are kept. Blocks with AC terms go through the inverse cosine
transform.

Shots: the 16-bin histogram of a frame's samples is compared with that of the frame before; a cut stands where the
difference exceeds the usual one of the WINDOW differences before it, and of those after it, by SPREAD standard
deviations and by LEAST. The usual one and the deviation are taken from the lower half of these differences, which other
cuts don't raise, so shots may be short: two frames on end, or a few of one frame. Differences that stay alike, however
large, are motion and not cuts. A side that the file's start or end leaves with less than half of WINDOW differences
doesn't count; where neither side counts both are taken together, and of under two differences LEAST alone decides.

Defined results: a null text is stored as an empty one; the payload is padded with spaces to a positive multiple of 192
bytes; equal texts give equal media; texts and files of any length are worked on whole, frames in runs of DECODED_BYTES;
null media, and bytes that aren't a RIFF AVI file, have no frames and no clips; of a file that breaks off the whole
frames count; a frame that can't be decoded (progressive, cut short, bad codes) shows what the frame before it does, or
grey; repeated rows are worked on each; an empty table gives no rows; extra columns stay in clips(), whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytesops as bo
from .scratch import fresh
from .subword import _ranges

BLOCKS_X, BLOCKS_Y, FPS = 16, 12, 25
FRAME_BYTES = BLOCKS_X * BLOCKS_Y
WINDOW, SPREAD, LEAST, HALF = 8, 3.0, 0.1, 0.6

#: Code lengths and symbols of the usual luminance DC table of JPEG.
DC_COUNTS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
DC_SYMBOLS = list(range(12))
#: Our AC table: end of block, and a run of 16 zeros.
AC_COUNTS, AC_SYMBOLS = [1, 1] + [0] * 14, [0x00, 0xF0]
#: The usual luminance AC table of JPEG, for files that leave their tables out: code lengths; symbols, which
#: from 0x25 on run up by row.
USUAL_AC_COUNTS = [0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125]
USUAL_AC_SYMBOLS = list(
    bytes.fromhex("01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a")
) + [16 * row + k for row in range(2, 16) for k in range({2: 5, 3: 4, 9: 2, 10: 2, 11: 2, 12: 2, 13: 2, 14: 1, 15: 1}.get(row, 3), 11)]
#: The JPEG zigzag order as (row, column), by rule: diagonals in turn, first along the top row.
ZIGZAG = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
#: Bytes of frames that are decoded at once.
DECODED_BYTES = 4 << 20
_COSINE = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(0.125) if u == 0 else 0.5) for u in range(8)] for x in range(8)])


def _codes(counts: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """Symbol to (code, length)."""
    found, code, k = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            found[symbols[k]] = (code, length)
            code, k = code + 1, k + 1
        code <<= 1
    return found


@lru_cache
def frame_header(blocks_x: int = BLOCKS_X, blocks_y: int = BLOCKS_Y) -> bytes:
    part = lambda mark, body: struct.pack(">BBH", 0xFF, mark, len(body) + 2) + body
    return (
        b"\xff\xd8"
        + part(0xDB, bytes([0] + [8] * 64))
        + part(0xC0, struct.pack(">BHHB3B", 8, blocks_y * 8, blocks_x * 8, 1, 1, 0x11, 0))
        + part(0xC4, bytes([0x00, *DC_COUNTS, *DC_SYMBOLS]))
        + part(0xC4, bytes([0x10, *AC_COUNTS, *AC_SYMBOLS]))
        + part(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
    )


@lru_cache
def _written() -> tuple[np.ndarray, np.ndarray]:
    """By DC difference + 255: the bits of the DC symbol, the difference and the end of block; their number."""
    dc, (eob, eob_n) = _codes(DC_COUNTS, DC_SYMBOLS), _codes(AC_COUNTS, AC_SYMBOLS)[0]
    bits, sizes = [], []
    for d in range(-255, 256):
        n = abs(d).bit_length()
        code, length = dc[n]
        bits.append((((code << n) | (d if d >= 0 else d + (1 << n) - 1)) << eob_n) | eob)
        sizes.append(length + n + eob_n)
    return np.array(bits, np.int64), np.array(sizes, np.int64)


def encode_frames(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """JPEG files of flat blocks, one after the other, and the n + 1 offsets of them. samples: frames x blocks, bytes."""
    n = len(samples)
    level = samples.astype(np.int64) - 128
    difference = np.diff(level, axis=1, prepend=0)
    table, lengths = _written()
    bits, sizes = table[difference + 255], lengths[difference + 255]
    ends = np.cumsum(sizes, axis=1)
    used = ends[:, -1]
    n_bytes = (used + 7) >> 3
    base = np.concatenate(([0], np.cumsum(n_bytes)))
    at = (base[:-1, None] << 3) + ends - sizes
    # A symbol has 16 bits at most, so it touches three bytes; the bits of different symbols never overlap.
    window = bits << (24 - (at & 7) - sizes)
    # The last byte is filled with ones.
    rest = (n_bytes << 3) - used
    window[:, -1] |= ((1 << rest) - 1) << (24 - (at[:, -1] & 7) - sizes[:, -1] - rest)
    where = (at >> 3).ravel()
    window = window.ravel()
    total = sum(np.bincount(where + k, (window >> (16 - 8 * k)) & 255, base[-1] + 3) for k in range(3))
    data = total[: base[-1]].astype(np.uint8)
    ff = data == 255
    stuffed = np.repeat(data, 1 + ff)
    stuffed[np.flatnonzero(ff) + np.arange(1, ff.sum() + 1)] = 0
    extra = np.concatenate(([0], np.cumsum(ff)))[base]
    scan = base + extra
    head = np.frombuffer(frame_header(), np.uint8)
    sizes = np.diff(scan) + len(head) + 2
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(offsets[-1], np.uint8)
    out[offsets[:-1, None] + np.arange(len(head))] = head
    out[_ranges(offsets[:-1] + len(head), np.diff(scan))] = stuffed
    out[offsets[1:, None] - np.array([2, 1])] = np.array([0xFF, 0xD9], np.uint8) if n else 0
    return out, offsets


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: np.ndarray, offsets: np.ndarray, width: int = BLOCKS_X * 8, height: int = BLOCKS_Y * 8, fps: int = FPS) -> bytes:
    """A RIFF AVI file of JPEG frames. frames, offsets: as encode_frames() gives them."""
    sizes = np.diff(offsets)
    n, room = len(sizes), sizes + (sizes & 1) + 8
    starts = np.concatenate(([0], np.cumsum(room)))
    movi = np.zeros(starts[-1], np.uint8)
    heads = np.zeros((n, 2), "<u4")
    heads[:, 0], heads[:, 1] = int.from_bytes(b"00dc", "little"), sizes
    movi[starts[:-1, None] + np.arange(8)] = heads.view(np.uint8).reshape(n, 8)
    movi[_ranges(starts[:-1] + 8, sizes)] = frames[offsets[0] : offsets[-1]]
    index = np.zeros((n, 4), "<u4")
    index[:, 0], index[:, 1], index[:, 2], index[:, 3] = int.from_bytes(b"00dc", "little"), 0x10, starts[:-1] + 4, sizes
    largest = int(sizes.max(initial=0))
    avih = struct.pack("<14I", 1_000_000 // fps, largest * fps, 0, 0x10, n, 0, 1, largest, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIiI4h", 0, 0, 0, 0, 1, fps, 0, n, largest, -1, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    return _chunk(b"RIFF", b"AVI " + hdrl + _chunk(b"LIST", b"movi" + movi.tobytes()) + _chunk(b"idx1", index.tobytes()))


def read_avi(media: bytes) -> tuple[np.ndarray, np.ndarray, float]:
    """Starts and sizes of the frames of the first video stream in a RIFF AVI file, by its index, and seconds a frame."""
    none = np.zeros(0, np.int64)
    if media[:4] != b"RIFF" or media[8:12] != b"AVI ":
        return none, none, 1 / FPS
    u32 = lambda at: int.from_bytes(media[at : at + 4], "little")
    at, end, movi, index, period = 12, len(media), None, None, 1 / FPS
    while at + 8 <= end:
        name, size = media[at : at + 4], min(u32(at + 4), end - at - 8)
        if name == b"LIST" and media[at + 8 : at + 12] == b"hdrl":
            k = media.find(b"avih", at + 12, at + 8 + size)
            period = u32(k + 8) / 1e6 or period if 0 <= k <= end - 12 else period
        elif name == b"LIST" and media[at + 8 : at + 12] == b"movi":
            movi = (at + 8, size)
        elif name == b"idx1":
            index = np.frombuffer(media, "<u4", size // 16 * 4, at + 8).reshape(-1, 4).astype(np.int64)
        at += 8 + size + (size & 1)
    if movi is None:
        return none, none, period
    if index is not None and len(index):
        # Offsets count from the word `movi`, or in some files from the start of the file.
        names, first = index[:, 0].astype("<u4"), int(index[0, 2])
        from_file = media[first : first + 4] == names[:1].tobytes() != media[movi[0] + first : movi[0] + first + 4]
        starts, sizes = index[:, 2] + 8 + (0 if from_file else movi[0]), index[:, 3]
    else:
        names, starts, sizes, k = [], [], [], movi[0] + 4
        while k + 8 <= movi[0] + movi[1]:
            if media[k : k + 4] == b"LIST":  # of `rec ` lists, what is in them
                k += 12
                continue
            names.append(u32(k))
            starts.append(k + 8)
            sizes.append(u32(k + 4))
            k += 8 + sizes[-1] + (sizes[-1] & 1)
        names, starts, sizes = np.array(names, "<u4"), np.array(starts, np.int64), np.array(sizes, np.int64)
    # Two digits of the stream, then `dc` or `db`.
    video = np.isin(names >> 16, [int.from_bytes(x, "little") for x in (b"dc", b"db")]) & (sizes > 0) & (starts + sizes <= end)
    stream = names & 0xFFFF
    video &= stream == stream[video][0] if video.any() else False
    return starts[video], sizes[video], period


def _lookup(counts: list[int], symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """By 16 bits ahead the lengths and symbols of the codes; length 0: no code."""
    lengths, found = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for s, (code, k) in _codes(counts, symbols).items():
        lengths[code << (16 - k) : (code + 1) << (16 - k)], found[code << (16 - k) : (code + 1) << (16 - k)] = k, s
    return lengths, found


class Kind:
    """What one kind of header says: of each block in a frame's scan the component and, for luminance, its place among the
    frame's blocks (else -1); of each component the quantiser and the tables; blocks between restart marks."""

    def __init__(self, header: bytes):
        at, quant, parts, restart, last = 2, {}, None, 0, -1
        tables = {0x00: (DC_COUNTS, DC_SYMBOLS), 0x10: (USUAL_AC_COUNTS, USUAL_AC_SYMBOLS)}
        tables |= {k + 1: v for k, v in tables.items()}
        while last != 0xDA:
            last, length = header[at + 1], struct.unpack_from(">H", header, at + 2)[0]
            body, at = header[at + 4 : at + 2 + length], at + 2 + length
            if last == 0xDB:
                while body:
                    if body[0] >> 4:
                        raise ValueError("8-bit quantisers only")
                    quant[body[0] & 15] = np.frombuffer(body[1:65], np.uint8).astype(np.int64)
                    body = body[65:]
            elif last in (0xC0, 0xC1):
                depth, height, width, n = struct.unpack_from(">BHHB", body)
                parts = [tuple(body[6 + 3 * k : 9 + 3 * k]) for k in range(n)]
                if depth != 8:
                    raise ValueError("8-bit samples only")
            elif 0xC2 <= last <= 0xCF and last != 0xC4:
                raise ValueError("baseline frames only")
            elif last == 0xC4:
                while body:
                    n = sum(body[1:17])
                    tables[body[0]] = (list(body[1:17]), list(body[17 : 17 + n]))
                    body = body[17 + n :]
            elif last == 0xDD:
                restart = struct.unpack_from(">H", body)[0]
        if body[0] != len(parts):
            raise ValueError("one interleaved scan only")
        used = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
        self.quant = [quant[q] for _, _, q in parts]
        self.dc, self.ac = ([_lookup(*tables[high | (used[i] >> shift & 15)]) for i, _, _ in parts] for high, shift in ((0, 4), (0x10, 0)))
        shape = [(1, 1)] if len(parts) == 1 else [(s >> 4, s & 15) for _, s, _ in parts]
        most_x, most_y = (max(s[k] for s in shape) for k in (0, 1))
        up = lambda a, b: -(-a // b)
        units_x, units_y = up(width, 8 * most_x), up(height, 8 * most_y)
        # Luminance blocks beyond the frame's edge belong to no place.
        own_x, own_y = up(up(width * shape[0][0], most_x), 8), up(up(height * shape[0][1], most_y), 8)
        self.blocks, self.order = own_x * own_y, []
        for unit in range(units_x * units_y):
            for part, (across, down) in enumerate(shape):
                for k in range(across * down):
                    x, y = unit % units_x * across + k % across, unit // units_x * down + k // across
                    self.order.append((part, y * own_x + x if not part and x < own_x and y < own_y else -1))
        self.restart = restart * sum(a * b for a, b in shape)


_kind = lru_cache(64)(Kind)


def _header(frame: bytes) -> bytes:
    """A frame's bytes up to the end of its scan header; empty if there is none."""
    at = 2
    while frame[:2] == b"\xff\xd8" and at + 4 <= len(frame) and frame[at] == 0xFF:
        end = at + 2 + int.from_bytes(frame[at + 2 : at + 4], "big")
        if frame[at + 1] == 0xDA:
            return frame[:end] if end <= len(frame) else b""
        at = end
    return b""


def decode_frames(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block means (frames x blocks, bytes; 0 beyond a smaller frame's blocks) of the luminance of baseline JPEGs, and
    whether each could be decoded. Frames with equal headers are decoded in step."""
    n = len(starts)
    out, ok = np.zeros((n, 0), np.uint8), np.zeros(n, bool)
    head = _header(data[starts[0] : starts[0] + sizes[0]].tobytes()) if n else b""
    alike = (sizes >= len(head)) & bool(head)
    alike[alike] = (data[starts[alike, None] + np.arange(len(head))] == np.frombuffer(head, np.uint8)).all(axis=1)
    kinds = {head: np.flatnonzero(alike).tolist()} if head else {}
    for k in np.flatnonzero(~alike).tolist():  # frames with other headers: each kind by itself
        kinds.setdefault(_header(data[starts[k] : starts[k] + sizes[k]].tobytes()), []).append(k)
    kinds.pop(b"", None)
    for header, rows in kinds.items():
        try:
            kind = _kind(header)
        except (ValueError, KeyError, IndexError, TypeError, struct.error):  # not a kind that is read
            continue
        part, fine = _decode(kind, data, starts[rows] + len(header), sizes[rows] - len(header))
        if part.shape[1] > out.shape[1]:
            out = np.pad(out, ((0, 0), (0, part.shape[1] - out.shape[1])))
        out[rows, : part.shape[1]], ok[rows] = part, fine
    return out, ok


def _decode(kind: Kind, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(starts)
    scan = data[_ranges(starts, sizes)]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    stuffing = np.zeros(len(scan), bool)
    stuffing[1:] = (scan[1:] == 0) & (scan[:-1] == 255)
    stuffing[bounds[:-1][sizes > 0]] = False
    bounds = bounds - np.concatenate(([0], np.cumsum(stuffing)))[bounds]
    scan = np.concatenate((scan[~stuffing], np.full(16, 255, np.uint8))).astype(np.int64)
    ahead = (scan[:-3] << 24) | (scan[1:-2] << 16) | (scan[2:-1] << 8) | scan[3:]
    at, end, ok = bounds[:-1] * 8, bounds[1:] * 8, np.ones(n, bool)
    level, dc, terms = np.zeros((n, kind.blocks), np.int64), np.zeros((len(kind.quant), n), np.int64), []

    def peek(at: np.ndarray) -> np.ndarray:
        return (ahead[at >> 3] >> (16 - (at & 7))) & 0xFFFF

    def value(at: np.ndarray, size: np.ndarray) -> np.ndarray:
        raw = peek(at) >> (16 - size)
        return np.where((size > 0) & (raw < (1 << np.maximum(size - 1, 0))), raw - (1 << size) + 1, raw)

    for b, (part, place) in enumerate(kind.order):
        if kind.restart and b and b % kind.restart == 0:  # the next byte begins a mark of two
            at = np.minimum(((at + 7) & ~7) + 16, end)
            dc[:] = 0
        (dc_n, dc_s), (ac_n, ac_s) = kind.dc[part], kind.ac[part]
        look = peek(at)
        size = np.minimum(dc_s[look], 15)
        ok &= dc_n[look] > 0
        at = at + dc_n[look]
        dc[part] += value(np.minimum(at, end), size)
        at = np.minimum(at + size, end + 8)
        if place >= 0:
            level[:, place] = dc[part]
        look = peek(at)
        ok &= ac_n[look] > 0
        at = at + ac_n[look]
        more = np.flatnonzero(ac_s[look] != 0)  # frames whose block goes on
        symbol, k = ac_s[look[more]], np.ones(len(more), np.int64)
        while len(more):
            run, size = symbol >> 4, symbol & 15
            k = k + run
            ok[more[k > 63]] = False
            if place >= 0:
                terms.append((more, np.full(len(more), place), np.minimum(k, 63), value(np.minimum(at[more], end[more]), size) * (size > 0)))
            at[more] = np.minimum(at[more] + size, end[more] + 8)
            k = k + 1
            left = k < 64
            more, k = more[left], k[left]
            look = peek(at[more])
            ok[more[ac_n[look] == 0]] = False
            at[more] += ac_n[look]
            left = (ac_s[look] != 0) & (ac_n[look] > 0)
            more, k, symbol = more[left], k[left], ac_s[look][left]
        at = np.minimum(at, end + 8)
    ok &= at <= end
    quant = kind.quant[0]
    if not terms:
        return np.clip((level * quant[0] + 4) // 8 + 128, 0, 255).astype(np.uint8), ok
    frame, block, k, v = (np.concatenate(x) for x in zip(*terms, strict=True))
    out = np.clip((level * quant[0] + 4) // 8 + 128, 0, 255).astype(np.uint8)
    # Only blocks with AC terms go through the transform, some at a time.
    which, place = np.unique(frame * kind.blocks + block, return_inverse=True)
    order = np.argsort(place, kind="stable")
    place, k, v = place[order], k[order], v[order]
    rows, cols = np.array(ZIGZAG).T
    for first in range(0, len(which), 1 << 14):
        some = which[first : first + (1 << 14)]
        a, z = np.searchsorted(place, (first, first + len(some)))
        spectrum = np.zeros((len(some), 8, 8))
        spectrum[:, 0, 0] = level.ravel()[some] * quant[0]
        spectrum[place[a:z] - first, rows[k[a:z]], cols[k[a:z]]] = v[a:z] * quant[k[a:z]]
        samples = np.clip(np.rint(_COSINE @ spectrum @ _COSINE.T + 128), 0, 255)
        out.reshape(-1)[some] = np.rint(samples.mean(axis=(1, 2)))
    return out, ok


def _bar(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a difference has to exceed, by the quiet half of those near it, and their number. near: a row for each, inf
    where there is none. The sd of the lower half of a normal sample is HALF of the whole one's."""
    near, number = np.sort(near, axis=1), np.isfinite(near).sum(axis=1)
    half = (number + 1) // 2
    quiet = np.arange(near.shape[1]) < half[:, None]
    low, some = np.where(quiet, near, 0), np.maximum(half, 1)
    mean = low.sum(axis=1) / some
    spread = np.sqrt((np.where(quiet, low - mean[:, None], 0) ** 2).sum(axis=1) / some) / HALF
    return low.max(axis=1) + np.maximum(SPREAD * spread, LEAST), number


def shots(samples: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each frame whether a shot begins with it. bounds: of each file's frames."""
    n = len(samples)
    count = np.bincount((np.arange(n)[:, None] * 16 + (samples >> 4)).ravel(), minlength=n * 16).reshape(n, 16)
    far = np.zeros(n)
    far[1:] = np.abs(np.diff(count, axis=0)).sum(axis=1) / (2 * max(samples.shape[1], 1))
    opening = np.zeros(n, bool)
    opening[bounds[:-1][np.diff(bounds) > 0]] = True
    # Differences exist from a file's second frame on.
    sizes = np.diff(bounds)
    first, last = np.repeat(bounds[:-1] + 1, sizes)[:, None], np.repeat(bounds[1:], sizes)[:, None]
    at = np.arange(n)[:, None] + np.concatenate((np.arange(-WINDOW, 0), np.arange(1, WINDOW + 1)))
    near = np.where((at >= first) & (at < last), far[np.clip(at, 0, n - 1)], np.inf)
    (before, n_before), (after, n_after), (both, n_both) = _bar(near[:, :WINDOW]), _bar(near[:, WINDOW:]), _bar(near)
    sides = np.maximum(np.where(n_before >= WINDOW // 2, before, 0), np.where(n_after >= WINDOW // 2, after, 0))
    bar = np.where(sides > 0, sides, np.where(n_both > 1, both, LEAST))
    return opening | (far > bar)


def payloads(array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bytes of each text, frames of samples, bounds of each text's frames) by slices."""
    for row, part in bo.slices(bo.texts(array), 1 << 20):
        data, offsets = bo.buffers(part)
        sizes = np.diff(offsets)
        frames = np.maximum(-(-sizes // FRAME_BYTES), 1)
        bounds = np.concatenate(([0], np.cumsum(frames)))
        padded = np.full(bounds[-1] * FRAME_BYTES, 32, np.uint8)
        padded[_ranges(bounds[:-1] * FRAME_BYTES, sizes)] = data
        yield row, sizes, padded.reshape(-1, FRAME_BYTES), bounds


def store(texts: pa.Array) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(first row, an AVI file for each text, bytes of each text) by slices."""
    for row, sizes, samples, bounds in payloads(texts):
        frames, offsets = encode_frames(samples)
        yield row, [write_avi(frames, offsets[a : b + 1]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], sizes


def load(media: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[float]]:
    """Samples of all frames, the bounds of each file's, where shots begin, and seconds a frame."""
    starts, sizes, counts, periods, at = [], [], [], [], 0
    for m in media:
        s, z, p = read_avi(m or b"")
        starts.append(s + at)
        sizes.append(z)
        counts.append(len(s))
        periods.append(p)
        at += len(m or b"")
    bounds = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    if not bounds[-1]:
        return np.zeros((0, FRAME_BYTES), np.uint8), bounds, np.zeros(0, bool), periods
    data = np.frombuffer(media[0] if len(media) == 1 else b"".join(m or b"" for m in media), np.uint8)
    starts, sizes, parts, first = np.concatenate(starts), np.concatenate(sizes), [], 0
    ends = np.cumsum(sizes)
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + DECODED_BYTES, "right")))
        parts.append(decode_frames(data, starts[first:last], sizes[first:last]))
        first = last
    widest = max(p.shape[1] for p, _ in parts)
    samples = np.concatenate([np.pad(p, ((0, 0), (0, widest - p.shape[1]))) for p, _ in parts])
    ok = np.concatenate([o for _, o in parts])
    if not ok.all():  # shown as the last good frame of the file, or grey
        shown = np.maximum.accumulate(np.where(ok, np.arange(len(ok)), -1))
        grey = shown < np.repeat(bounds[:-1], np.diff(bounds))
        samples = np.where(grey[:, None], np.uint8(128), samples[np.maximum(shown, 0)])
    return samples, bounds, shots(samples, bounds), periods


CLIP = pa.struct([("clip", pa.int64()), ("first_frame", pa.int64()), ("n_frames", pa.int64()), ("start_s", pa.float64()), ("end_s", pa.float64())])


def encode(text: str) -> Column:
    """The AVI file that holds a text column's payload."""

    @F.arrow_udf("binary")
    def encoded(column: pa.Array) -> pa.Array:
        return pa.array([m for _, files, _ in store(column) for m in files], pa.binary())

    return encoded(F.col(text))


def _timed(bounds: np.ndarray, begins: np.ndarray, periods: list[float]) -> list[list[dict]]:
    """The clips of each file."""
    out = []
    for a, b, p in zip(bounds[:-1], bounds[1:], periods, strict=True):
        at = np.append(np.flatnonzero(begins[a:b]), b - a).tolist()
        out.append([{"clip": i, "first_frame": s, "n_frames": e - s, "start_s": s * p, "end_s": e * p} for i, (s, e) in enumerate(zip(at[:-1], at[1:], strict=True))])
    return out


_CLIPS = "array<struct<clip:bigint,first_frame:bigint,n_frames:bigint,start_s:double,end_s:double>>"


def clips(docs: DataFrame, media: str) -> DataFrame:
    """Timed clip rows of a column of AVI files: the other columns, then clip, first_frame, n_frames, start_s, end_s."""

    @F.arrow_udf(_CLIPS)
    def cut(column: pa.Array) -> pa.Array:
        out, some, size = [], [], 0
        for file in column:
            some.append(file.as_py())
            size += len(some[-1] or b"")
            if size >= DECODED_BYTES:
                out += _timed(*load(some)[1:])
                some, size = [], 0
        return pa.array(out + _timed(*load(some)[1:]), pa.list_(CLIP))

    name = fresh("cut", docs)
    rest = [F.col(c) for c in docs.columns if c != media]
    return docs.select(*rest, F.explode(cut(F.col(media))).alias(name)).select(*rest, F.col(f"{name}.*"))


DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, what is read back from the AVI file of each whole text, the file's timed clips, and as `feature` the frames
    and the clips' first frames."""

    @F.arrow_udf(f"struct<{DIGEST.replace(' long', ':bigint').replace(' string', ':string')}, clips:{_CLIPS}>")
    def made(column: pa.Array) -> pa.Array:
        out = []
        for _, files, sizes in store(column):
            samples, bounds, begins, periods = load(files)
            for m, n, a, b, cut in zip(files, sizes.tolist(), bounds[:-1], bounds[1:], _timed(bounds, begins, periods), strict=True):
                payload = samples[a:b].tobytes()
                out.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), cut))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(CLIP)]
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*[x.split()[0] for x in DIGEST.split(", ")], "clips"])

    begin = F.array_join(F.transform("m.clips", lambda c: c["first_frame"].cast("string")), ",")
    frames = F.aggregate("m.clips", F.lit(0).cast("long"), lambda n, c: n + c["n_frames"])
    feature = F.concat(F.lit("frames="), frames.cast("string"), F.lit(";shots="), F.size("m.clips").cast("string"), F.lit(";begin="), begin)
    return docs.select("doc_id", made(F.col("text")).alias("m")).select("doc_id", "m.*", feature.alias("feature"))
