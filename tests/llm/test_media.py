"""The decoder against coefficients that a slow encoder of its own has written, and files that are not as they should be."""

import struct

import numpy as np
import pytest

from loomsql.llm import media

DC = media._codes(media.DC_COUNTS, media.DC_SYMBOLS)
AC = media._codes(media.USUAL_AC_COUNTS, media.USUAL_AC_SYMBOLS)
#: The first places of the zigzag order, (row, column), as the standard's figure has them.
FIRST = [(0, 0), (0, 1), (1, 0), (2, 0), (1, 1), (0, 2), (0, 3), (1, 2), (2, 1), (3, 0), (4, 0), (3, 1)]


def part(mark, body):
    return struct.pack(">BBH", 0xFF, mark, len(body) + 2) + body


def number(v):
    n = abs(v).bit_length()
    return format(v if v > 0 else v + (1 << n) - 1, f"0{n}b") if n else ""


def code(table, symbol):
    value, n = table[symbol]
    return format(value, f"0{n}b")


def block_bits(coefficients, before):
    d = int(coefficients[0]) - before
    out, run = code(DC, abs(d).bit_length()) + number(d), 0
    last = max([k for k in range(64) if coefficients[k]], default=0)
    for v in map(int, coefficients[1 : last + 1]):
        if not v:
            run += 1
            continue
        while run > 15:
            out, run = out + code(AC, 0xF0), run - 16
        out, run = out + code(AC, run << 4 | abs(v).bit_length()) + number(v), 0
    return out if last == 63 else out + code(AC, 0)


def packed(bits):
    bits += "1" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def jpeg(width, height, blocks, quant, shape=((1, 1),), restart=0, tables=True, sof=0xC0):
    """blocks: (component, 64 coefficients in zigzag order) as they stand in the scan."""
    per_unit = sum(a * b for a, b in shape)
    scan, bits, before = b"", "", [0] * len(shape)
    for i, (c, coefficients) in enumerate(blocks):
        if restart and i and i % (restart * per_unit) == 0:
            scan, bits, before = scan + packed(bits) + bytes([0xFF, 0xD0 + (i // (restart * per_unit) - 1) % 8]), "", [0] * len(shape)
        bits += block_bits(coefficients, before[c])
        before[c] = int(coefficients[0])
    head = b"\xff\xd8" + part(0xDB, bytes([0, *quant]))
    head += part(sof, struct.pack(">BHHB", 8, height, width, len(shape)) + b"".join(bytes([c + 1, a << 4 | b, 0]) for c, (a, b) in enumerate(shape)))
    if tables:
        head += part(0xC4, bytes([0, *media.DC_COUNTS, *media.DC_SYMBOLS])) + part(0xC4, bytes([0x10, *media.USUAL_AC_COUNTS, *media.USUAL_AC_SYMBOLS]))
    head += part(0xDD, struct.pack(">H", restart)) if restart else b""
    return head + part(0xDA, bytes([len(shape), *[x for c in range(len(shape)) for x in (c + 1, 0)], 0, 63, 0])) + scan + packed(bits) + b"\xff\xd9"


def mean(coefficients, quant):
    """By the definition of the inverse transform, sample by sample."""
    total = 0
    zigzag = media.ZIGZAG
    for y in range(8):
        for x in range(8):
            s = 0.0
            for k in np.flatnonzero(coefficients):
                v, u = zigzag[k]
                s += coefficients[k] * quant[k] * (1 if u else 0.5**0.5) * (1 if v else 0.5**0.5) * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) / 4
            total += min(255, max(0, round(s + 128)))
    return total / 64


def random_block(rng, most=9):
    out = np.zeros(64, np.int64)
    out[0] = rng.integers(-60, 60)
    for k in rng.choice(np.arange(1, 64), rng.integers(0, most), replace=False):
        out[k] = rng.integers(-20, 21)
    return out


def decoded(*frames):
    data = np.frombuffer(b"".join(frames), np.uint8)
    sizes = np.array([len(f) for f in frames])
    return media.decode_frames(data, np.cumsum(sizes) - sizes, sizes)


def avi(frames):
    return media.write_avi(np.frombuffer(b"".join(frames), np.uint8), np.cumsum([0, *[len(f) for f in frames]]))


def test_zigzag_and_usual_table():
    assert media.ZIGZAG[:12] == FIRST and media.ZIGZAG[-1] == (7, 7) and len(set(media.ZIGZAG)) == 64
    assert len(media.USUAL_AC_SYMBOLS) == sum(media.USUAL_AC_COUNTS) == 162 == len(set(media.USUAL_AC_SYMBOLS))
    assert {s & 15 for s in media.USUAL_AC_SYMBOLS} == set(range(11))


@pytest.mark.parametrize("tables", [True, False])
@pytest.mark.parametrize("restart", [0, 2])
def test_grey_frames_with_ac_terms(tables, restart):
    rng = np.random.default_rng(1)
    quant = rng.integers(1, 9, 64).tolist()
    blocks = [[random_block(rng) for _ in range(6)] for _ in range(4)]
    blocks[0][0][[1, 63]] = 3, -2  # the last coefficient, after runs of more than 16
    out, ok = decoded(*[jpeg(24, 16, [(0, b) for b in frame], quant, restart=restart, tables=tables) for frame in blocks])
    assert ok.all() and out.shape == (4, 6)
    for frame, row in zip(blocks, out, strict=True):
        for b, got in zip(frame, row, strict=True):
            assert abs(mean(b, quant) - got) <= 1  # a flat block may round a half up


def test_luminance_of_colour_frames():
    rng = np.random.default_rng(2)
    quant, shape = [3] * 64, ((2, 2), (1, 1), (1, 1))
    units = [[random_block(rng, 4) for _ in range(6)] for _ in range(4)]  # 20 x 24 samples: two units across and two down
    frame = jpeg(20, 24, [((0, 0, 0, 0, 1, 2)[k], b) for unit in units for k, b in enumerate(unit)], quant, shape, restart=1)
    out, ok = decoded(frame, frame)
    want = {(y, x): units[y // 2 * 2 + x // 2][y % 2 * 2 + x % 2] for y in range(4) for x in range(4) if x < 3 and y < 3}
    assert ok.all() and out.shape == (2, 9) and (out[0] == out[1]).all()
    for (y, x), b in want.items():
        assert abs(mean(b, quant) - out[0][y * 3 + x]) <= 1  # a flat block may round a half up


def test_many_headers_do_not_recurse():
    flat = np.zeros(64, np.int64)
    frames = []
    for k in range(1500):
        flat[0] = k % 50
        frames.append(jpeg(8, 8 + k % 3, [(0, flat.copy())] * (1 + (k % 3 > 0)), [1 + k // 50] * 64))
    out, ok = decoded(*frames)
    assert ok.all() and [int(x) for x in out[:3, 0]] == [128, 128, 128] and out[49 + 7 * 50, 0] == 128 + 49 * 8 // 8


def test_bad_frames_show_the_one_before():
    rng = np.random.default_rng(3)
    quant, blocks = [2] * 64, [(0, random_block(rng)) for _ in range(4)]
    good, progressive = jpeg(16, 16, blocks, quant), jpeg(16, 16, blocks, quant, sof=0xC2)
    short, noise = good[: len(good) // 2 + 60], bytes(rng.integers(0, 256, 200).astype(np.uint8))
    samples, bounds, begins, _ = media.load([avi([progressive, good, noise, good, short]), avi([noise])])
    assert bounds.tolist() == [0, 5, 6] and (samples[0] == 128).all() and (samples[5] == 128).all()
    assert (samples[1] == samples[2]).all() and (samples[3] == samples[4]).all()
    assert not decoded(b"", b"\xff\xd8\xff")[1].any()


def test_files_that_break_off_or_are_none():
    frames, offsets = media.encode_frames(np.full((6, 192), 60, np.uint8))
    whole = media.write_avi(frames, offsets)
    for cut in (0, 3, 8, 12, 60, 300, len(whole) // 2, len(whole) - 5):
        n = len(media.read_avi(whole[:cut])[0])
        assert n <= 6 and media.load([whole[:cut]])[0].shape[0] == n
    assert len(media.read_avi(whole[: len(whole) // 2])[0]) >= 2  # there the index is lost
    assert len(media.read_avi(b"GIF89a" * 9)[0]) == 0 and media.load([None, b"x"])[1].tolist() == [0, 0, 0]
    # Frames in `rec ` lists, of the second stream, and no index.
    rec = media._chunk(b"LIST", b"rec " + media._chunk(b"00wb", b"sound") + media._chunk(b"01dc", frames[: offsets[1]].tobytes()))
    file = media._chunk(b"RIFF", b"AVI " + media._chunk(b"LIST", b"movi" + rec + rec))
    assert (media.load([file])[0] == 60).all() and len(media.read_avi(file)[0]) == 2


def test_clips_of_a_column(spark):
    frames, offsets = media.encode_frames(np.repeat(np.array([[20], [220]], np.uint8), [30, 20], axis=0) * np.ones(192, np.uint8))
    rows = [(1, bytearray(media.write_avi(frames, offsets)), "a"), (2, None, "b"), (3, bytearray(b"none"), "c"), (4, bytearray(media.write_avi(frames, offsets)), "a")]
    videos = spark.createDataFrame(rows, "id long, video binary, cut string")
    got = sorted((r["id"], r["cut"], r["clip"], r["first_frame"], r["n_frames"], r["end_s"]) for r in media.clips(videos, "video").collect())
    assert got == [(i, "a", k, f, n, pytest.approx(e)) for i in (1, 4) for k, f, n, e in ((0, 0, 30, 1.2), (1, 30, 20, 2.0))]
    assert media.clips(videos.limit(0), "video").collect() == []


def test_the_query_has_the_clips_of_its_files(spark):
    docs = spark.createDataFrame([(1, "a" * 192 * 12 + "é" * 96 * 12), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in media.digest(docs).collect()}
    files = docs.select("doc_id", media.encode("text").alias("video"))
    for i, n in ((1, 24), (2, 1)):
        rows = media.clips(files.where(f"doc_id = {i}"), "video").drop("doc_id").collect()
        assert [tuple(c) for c in found[i]["clips"]] == [tuple(r) for r in rows] and sum(r["n_frames"] for r in rows) == n
        assert found[i]["feature"] == f"frames={n};shots={len(rows)};begin={','.join(str(r['first_frame']) for r in rows)}"
    assert len(found[1]["clips"]) == 2
