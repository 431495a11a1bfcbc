import hashlib
import struct
import zlib

import numpy as np
import pytest

from taxaloom.llm import media as m
from taxaloom.llm.common import documents, ship


class Bits:
    def __init__(self, raw):
        self.bits = "".join(f"{b:08b}" for b in raw)
        self.at = 0

    def take(self, n):
        x = self.bits[self.at : self.at + n]
        self.at += n
        return int(x, 2) if n else 0

    def symbol(self, code):
        codes, lengths = code.codes
        known = {f"{int(codes[s]):0{int(lengths[s])}b}": s for s in code.symbols}
        n = 1
        while self.bits[self.at : self.at + n] not in known:
            n += 1
        s = known[self.bits[self.at : self.at + n]]
        self.at += n
        return s


def extend(v, s):
    return v - (1 << s) + 1 if s and v < 1 << (s - 1) else v


def plain_decode(data):
    """One coefficient at a time, one file of `write` at a time."""
    full = [i for i in range(len(data) - 1) if data[i] == 0xFF and data[i + 1] not in (0, 0xFF) and not 0xD0 <= data[i + 1] <= 0xD7]
    image = m.parse(data, 0, len(data), np.array(full))
    for s in image.scans:
        raw = data[s.start : s.end]
        lanes = [b""]
        i = 0
        while i < len(raw):
            if raw[i] == 0xFF and raw[i + 1] != 0:
                lanes.append(b"")
                i += 2
            else:
                lanes[-1] += raw[i : i + 1]
                i += 2 if raw[i] == 0xFF else 1
        plane = image.planes[s.components[0]]
        assert len(lanes) == len(plane)
        for block, lane in zip(plane, lanes):
            b = Bits(lane)
            if s.ss == 0:
                if s.ah:
                    block[0] |= b.take(1) << s.al
                else:
                    t = b.symbol(s.dc[0])
                    block[0] = extend(b.take(t), t) << s.al
                continue
            k = s.ss
            while k <= s.se:
                sym = b.symbol(s.ac[0])
                r, t = sym >> 4, sym & 15
                if t == 0 and r < 15:
                    assert r == 0
                    if s.ah:
                        for j in range(k, s.se + 1):
                            if block[j]:
                                block[j] += (1 if block[j] > 0 else -1) * (b.take(1) << s.al)
                    break
                new = 0
                if s.ah:
                    if t:
                        new = (1 if b.take(1) else -1) << s.al
                    while True:
                        if block[k]:
                            block[k] += (1 if block[k] > 0 else -1) * (b.take(1) << s.al)
                        elif r == 0:
                            break
                        else:
                            r -= 1
                        k += 1
                    if t:
                        block[k] = new
                elif t:
                    k += r
                    block[k] = extend(b.take(t), t) << s.al
                else:
                    k += 15
                k += 1
            assert set(b.bits[b.at :]) <= {"1"} and len(b.bits) - b.at < 8
    return image


def blocks_of(kind, n, rnd):
    v = rnd.integers(-128, 128, (n, 64))
    if kind == "sparse":
        v = np.where(rnd.random((n, 64)) < 0.95, 0, v)
    if kind == "small":
        v = rnd.integers(-2, 3, (n, 64))
    if kind == "few":
        v = np.where(rnd.random((n, 64)) < 0.9, 0, rnd.integers(-2, 3, (n, 64)))
    return v.astype(np.int16)


@pytest.mark.parametrize("kind", ["dense", "sparse", "small", "few"])
def test_lockstep_is_the_plain_decoder(kind):
    rnd = np.random.default_rng(3)
    sizes = np.array([1, 4, 6, 7, 13])
    v = blocks_of(kind, int(sizes.sum()), rnd)
    files = m.write(v, sizes, [b"x"] * 5)
    at = 0
    for f, image, n in zip(files, m.read(files), sizes):
        want = plain_decode(f)
        for a, b in zip(image.planes, want.planes):
            assert (a == b).all()
        assert (m.read([f])[0].planes[0] == want.planes[0]).all()
        luma = min(int(n), len(want.planes[0]))
        assert (want.planes[0][:luma] == v[at : at + luma]).all()
        at += n


def put(bits):
    bits += "1" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def test_interleaved_scans_and_long_band_ends():
    """A hand-made file: one interleaved DC scan, predictions across blocks, an end-of-band run over several blocks."""
    code = m._code([(8, [*range(12), 0x10, 0x20, 0x01, 0x02, 0x03, 0xF0][:12] + [0x10, 0x20, 0xF0])])
    word = lambda s: f"{int(code.codes[0][s]):08b}"

    def number(v):
        s = abs(v).bit_length()
        return s, f"{(v if v > 0 else v + (1 << s) - 1):0{s}b}" if s else ""

    dc = {0: [5, -7, 12, 100], 1: [-3], 2: [0]}
    bits, pred = "", {0: 0, 1: 0, 2: 0}
    for c in (0, 1, 2):
        for v in dc[c]:
            s, x = number(v - pred[c])
            pred[c] = v
            bits += word(s) + x
    frame = struct.pack(">BHHB", 8, 16, 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    head = bytes([0xFF, 0xD8]) + m._segment(m.DQT, bytes([0]) + bytes([2] * 64)) + m._segment(m.SOF2, frame)
    head += m._segment(m.DHT, bytes([0x00, *code.counts]) + code.symbols + bytes([0x10, *code.counts]) + code.symbols)
    data = head + m._segment(m.SOS, bytes([3, 1, 0, 2, 0, 3, 0, 0, 0, 0])) + put(bits)
    # luma AC 1..63: block 0 has 9 at place 3, then an end-of-band run of 1 + 1 blocks more (symbol 0x10, one bit): blocks 0, 1, 2 end; block 3 has -2 at place 1
    s9, x9 = number(9)
    s2, x2 = number(-2)
    ac = word(0x20 | s9) if (0x20 | s9) in code.symbols else None
    assert ac is None  # the code has no run symbols with sizes: put 9 first in its band instead
    bits = word(s9) + x9 + word(0x10) + "1" + word(s2) + x2 + word(0)
    data += m._segment(m.SOS, bytes([1, 1, 0, 1, 63, 0])) + put(bits) + bytes([0xFF, 0xD9])
    image = m.read([data])[0]
    assert [int(x[0]) for x in image.planes[0]] == dc[0] and int(image.planes[1][0, 0]) == -3 and int(image.planes[2][0, 0]) == 0
    want = np.zeros((4, 63), int)
    want[0, 0], want[3, 0] = 9, -2
    assert (image.planes[0][:, 1:] == want).all()
    pixels = m.tensor(image)
    assert pixels.shape == (16, 16, 3)
    y = 128 + 2 * 100 / 8 + 0  # flat part of the last luma block: DC alone but for one small cosine
    cb = 2 * -3 / 8
    assert abs(float(pixels[8:, 8:, 0].mean()) - y) < 1.5 and abs(float(pixels[8:, 8:, 2].mean()) - (y + 1.772 * round(cb))) < 2


def test_samples_are_the_inverse_transform():
    rnd = np.random.default_rng(1)
    x = rnd.integers(-100, 100, (20, 64))
    c = np.array([[(np.sqrt(1 / 8) if u == 0 else 0.5) * np.cos((2 * i + 1) * u * np.pi / 16) for i in range(8)] for u in range(8)])
    for row, got in zip(x, m.samples(x)):
        square = np.zeros((8, 8))
        for (r, k), v in zip(m.ZIGZAG, row):
            square[r, k] = v
        assert np.abs(np.clip(c.T @ square @ c + 128, 0, 255) - got).max() <= 0.51
    assert m.ZIGZAG[:6] == [(0, 0), (0, 1), (1, 0), (2, 0), (1, 1), (0, 2)]


def test_damage_raises():
    f = m.write(np.full((6, 64), 9, np.int16), np.array([6]), [b""])[0]
    for bad in (f[:-40], b"\x00" + f[1:], f[:20]):
        with pytest.raises((m.MediaError, ValueError, struct.error, IndexError)):
            m.read([bad])


def check(rows, out):
    seen = {}
    assert len(out) == len(rows)
    want = {(d, (t or "")) for d, t in rows}
    for r in out:
        raw = next((t for d, t in want if d == r.doc_id and hashlib.sha256(pad(t)).hexdigest() == r.payload_sha256), None)
        assert raw is not None
        assert (r.n_bytes, r.payload_bytes) == (len(raw.encode()), len(pad(raw)))
        assert r.tail_crc32 == zlib.crc32(pad(raw)[-64:])
        assert seen.setdefault(raw, (r.media_sha256, r.feature, r.media_bytes)) == (r.media_sha256, r.feature, r.media_bytes)
    assert len(set(seen.values())) == len(seen)


def pad(t):
    raw = t.encode()
    return raw + bytes(-len(raw) % 64 if raw else 64)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]
    check(rows, m.op9_progressive_jpeg(spark, sf_dir).collect())


def test_odd_rows(spark, tmp_path):
    ship(spark)
    rows = [(1, "a" * 64), (2, None), (3, ""), (None, "é\x7f\x80\x00ÿ" * 40), (4, "a" * 64), (5, " " * 500), (6, "b" * 700_000), (1, "a" * 64)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows[1] = (2, "")
    check(rows, m.op9_progressive_jpeg(spark, str(tmp_path)).collect())
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e" / "documents.parquet"))
    assert m.op9_progressive_jpeg(spark, str(tmp_path / "e")).collect() == []
    shown = m.load(m.store(spark.createDataFrame([(1, "abc" * 500)], "doc_id long, text string")), with_tensor=True).collect()[0]
    assert len(shown.tensor) == 3 * shown.height * shown.width
