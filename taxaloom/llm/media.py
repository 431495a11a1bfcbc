"""Media columns: progressive JPEG files to coefficient arrays and full-resolution RGB tensors.

A file's scans are read in order. Spectral-selection scans fill bands of the coefficient arrays,
successive-approximation scans add one bit to what is there. Entropy-coded data is cut at its restart
markers into lanes; all lanes of equal scans, of one file or of a whole batch, are decoded in lockstep:
one step reads one Huffman symbol in each lane from a table of all 16-bit prefixes. Coefficients are
dequantised and inverse-transformed by one product with an integer basis, exact in float64, so equal
files give equal tensors in any batch. Chroma is upsampled by repetition before the colour transform.

`write` makes such files from coefficients: five scans a component (DC and two AC bands without their
last bit, then the last bits), a restart after every block, three components at 4:2:0. A payload is
stored losslessly in the format's unit, the quantised coefficient: byte b is coefficient b - 128, save
that the three bytes which would give -1, 0 and 1 change places with three that UTF-8 never has.

Defined results. A null or empty text is one block of zero bytes. Damaged or unsupported files raise.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import repeat_ranges, text_chunks, utf8_view

#: The zigzag order of an 8 x 8 block, by row and column.
ZIGZAG = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
BASIS_BITS = 20
BYTES = 400_000


class MediaError(ValueError):
    pass


# --- codes -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Huffman:
    """Symbols by code length, as a file has them."""

    counts: tuple[int, ...]
    symbols: bytes

    @functools.cached_property
    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and length by symbol."""
        code, at = 0, 0
        codes, lengths = np.zeros(256, np.uint64), np.zeros(256, np.int64)
        for length, n in enumerate(self.counts, 1):
            for s in self.symbols[at : at + n]:
                codes[s], lengths[s] = code, length
                code += 1
            at += n
            code <<= 1
        return codes, lengths

    @functools.cached_property
    def table(self) -> np.ndarray:
        """By 16-bit prefix: symbol and length * 256; 0 where no code begins so."""
        out = np.zeros(1 << 16, np.int64)
        codes, lengths = self.codes
        for s in self.symbols:
            n = int(lengths[s])
            a = int(codes[s]) << (16 - n)
            out[a : a + (1 << (16 - n))] = s | n << 8
        return out

    @functools.cached_property
    def whole(self) -> np.ndarray:
        """By 16-bit prefix that holds a symbol with all its bits: length, run and value (5, 4 and 16 bits); else 0."""
        x = np.arange(1 << 16)
        found = self.table
        length, r, s = found >> 8, found >> 4 & 15, found & 15
        total = length + s
        ok = (length > 0) & (s > 0) & (total <= 16)
        v = (x >> np.maximum(16 - total, 0)) & ((1 << s) - 1)
        v = np.where(v < (1 << np.maximum(s - 1, 0)), v - (1 << s) + 1, v)
        return np.where(ok, total << 20 | r << 16 | (v & 0xFFFF), 0).astype(np.int32)


def _code(groups: list[tuple[int, list[int]]]) -> Huffman:
    counts = [0] * 16
    for length, symbols in groups:
        counts[length - 1] += len(symbols)
    return Huffman(tuple(counts), bytes(s for _, symbols in sorted(groups) for s in symbols))


#: The codes that `write` uses: short where a coefficient follows another one at once.
DC_CODE = _code([(4, list(range(12)))])
AC_CODE = _code([(4, [0x00, *range(1, 9)]), (9, [r << 4 | s for r in range(1, 16) for s in range(1, 11)] + [0xF0, 0x09, 0x0A])])

SOI, EOI, SOS, DQT, DHT, SOF2, DRI, COM = 0xD8, 0xD9, 0xDA, 0xDB, 0xC4, 0xC2, 0xDD, 0xFE


# --- writing ---------------------------------------------------------------------------------------


def _category(a: np.ndarray) -> np.ndarray:
    return np.where(a > 0, np.frexp(a.astype(np.float64))[1], 0).astype(np.int64)


def _extra(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The bits that follow a category: v itself, or v - 1 in s bits if it is negative."""
    return (np.where(v < 0, v - 1, v) & ((1 << s) - 1)).astype(np.uint64)


def _dc_first(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = v[:, :1].astype(np.int64) >> 1
    s = _category(np.abs(d))
    code, length = DC_CODE.codes
    return code[s] << s.astype(np.uint64) | _extra(d, s), length[s] + s


@functools.lru_cache(maxsize=1)
def _dense() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each coefficient in -256..255 that follows another one at once, without its last bit."""
    v = np.arange(-256, 256)
    a = np.sign(v) * (np.abs(v) >> 1)
    s = _category(np.abs(a))
    code, length = AC_CODE.codes
    return (code[s] << s.astype(np.uint64) | _extra(a, s)).astype(np.uint32), (length[s] + s).astype(np.uint8)


def _ac_first(v: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    band = v[:, first : last + 1]
    mag = np.abs(band)
    if band.size and mag.min() > 1 and mag.max() < 256:
        bits, size = _dense()
        at = band + 256
        return bits[at].astype(np.uint64), size[at].astype(np.int64)
    band = band.astype(np.int64)
    a = np.sign(band) * (np.abs(band) >> 1)
    some = a != 0
    col = np.arange(a.shape[1])
    seen = np.maximum.accumulate(np.where(some, col, -1), axis=1)
    before = np.concatenate([np.full((len(a), 1), -1), seen[:, :-1]], 1)
    run = col - before - 1
    s = _category(np.abs(a))
    code, length = AC_CODE.codes
    symbol = (run & 15) << 4 | s
    bits = code[symbol] << s.astype(np.uint64) | _extra(a, s)
    size = length[symbol] + s
    skip, skip_size = int(code[0xF0]), int(length[0xF0])
    for _ in range(3):
        more = some & (run >= 16)
        if not more.any():
            break
        bits = np.where(more, bits | np.uint64(skip) << size.astype(np.uint64), bits)
        size = np.where(more, size + skip_size, size)
        run = run - 16
    bits, size = np.where(some, bits, np.uint64(0)), np.where(some, size, 0)
    open_ = seen[:, -1] != a.shape[1] - 1
    end = np.where(open_, code[0], np.uint64(0))[:, None]
    return np.concatenate([bits, end], 1), np.concatenate([size, np.where(open_, length[0], 0)[:, None]], 1)


def _dc_refine(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (v[:, :1] & 1).astype(np.uint64), np.ones((len(v), 1), np.int64)


def _ac_refine(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Correction bits behind one end-of-band symbol; blocks with new coefficients need symbols in between."""
    band = v[:, 1:].astype(np.int64)
    mag = np.abs(band)
    old = mag > 1
    code, length = AC_CODE.codes
    n, w = band.shape
    bits = np.zeros((n, 2 * w + 1), np.uint64)
    size = np.zeros((n, 2 * w + 1), np.int64)
    new = mag == 1
    plain = np.flatnonzero(~new.any(1))
    bits[plain, 0], size[plain, 0] = code[0], length[0]
    bits[plain, 1 : w + 1], size[plain, 1 : w + 1] = mag[plain] & 1, old[plain]
    rows = np.flatnonzero(new.any(1))
    if len(rows):
        o, x, val, m = old[rows], new[rows], band[rows], mag[rows]
        zero = ~o & ~x
        total = np.cumsum(zero, 1)
        base = np.maximum.accumulate(np.where(x, total, 0), axis=1)
        base = np.concatenate([np.zeros((len(rows), 1), base.dtype), base[:, :-1]], 1)
        since = total - base
        later = np.cumsum(x[:, ::-1], 1)[:, ::-1] - x > 0
        skip = zero & (since % 16 == 0) & later
        mark = x | skip
        group = np.cumsum(mark, 1) - mark
        col = np.arange(w)
        key = [group * 200 + 1 + col, group * 200]  # corrections, then the symbol that leads each group
        symbol = np.where(x, (since % 16) << 4 | 1, 0xF0)
        lead = code[symbol] << np.uint64(1) | (val > 0).astype(np.uint64)
        lead = np.where(x, lead, code[0xF0])
        lead_size = np.where(mark, length[symbol] + x, 0)
        rest = ~mark[:, -1]
        last = np.cumsum(mark, 1)[:, -1]
        keys = np.concatenate([np.where(o, key[0], 10**6), np.where(mark, key[1], 10**6), np.where(rest, last * 200, 10**6)[:, None]], 1)
        b = np.concatenate([(m & 1).astype(np.uint64), lead, np.full((len(rows), 1), code[0])], 1)
        s = np.concatenate([o.astype(np.int64), lead_size, np.where(rest, length[0], 0)[:, None]], 1)
        order = np.argsort(keys, axis=1, kind="stable")
        bits[rows], size[rows] = np.take_along_axis(b, order, 1), np.take_along_axis(s, order, 1)
    return bits, size


def _entropy(bits: np.ndarray, size: np.ndarray, turn: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of all blocks, each padded with ones, stuffed, and followed by its restart marker unless final; and bytes for each block."""
    n = len(bits)
    total = size.sum(1)
    whole = (total + 7) >> 3
    at = np.cumsum(whole) - whole
    size = np.concatenate([size, (whole * 8 - total)[:, None]], 1)
    ones = (np.uint64(1) << size[:, -1].astype(np.uint64)) - np.uint64(1)
    bits = np.concatenate([np.where(size[:, :-1] > 0, bits, np.uint64(0)), ones[:, None]], 1)
    while bits.shape[1] > 1 and 2 * int(size.max()) <= 64:  # neighbours become one word
        if bits.shape[1] % 2:
            bits, size = (np.concatenate([np.zeros((n, 1), x.dtype), x], 1) for x in (bits, size))
        bits = bits[:, ::2] << size[:, 1::2].astype(np.uint64) | bits[:, 1::2]
        size = size[:, ::2] + size[:, 1::2]
    flat, flat_size = bits.ravel(), size.ravel()
    keep = flat_size > 0
    flat, flat_size = flat[keep], flat_size[keep]
    off = np.cumsum(flat_size) - flat_size
    word, shift = off >> 6, off & 63
    words = np.zeros(int(whole.sum()) // 8 + 2, np.uint64)
    left = flat << (64 - flat_size).astype(np.uint64)
    head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words[word[head]] = np.bitwise_or.reduceat(left >> shift.astype(np.uint64), head)
    spill = np.flatnonzero(shift + flat_size > 64)
    words[word[spill] + 1] |= left[spill] << (64 - shift[spill]).astype(np.uint64)
    raw = words.astype(">u8").view(np.uint8)[: int(whole.sum())]
    return _framed((raw, whole), turn, final)


def _all_old(v: np.ndarray) -> bool:
    return bool(v.size) and int(np.abs(v[:, 1:]).min()) > 1


def _refine_bytes(v: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Last bits of blocks without new coefficients: one end-of-band symbol, then the bits, then ones."""
    if not first:
        return ((v[:, 0] & 1) << 7 | 0x7F).astype(np.uint8), np.ones(len(v), np.int64)
    code, length = (int(x[0]) for x in AC_CODE.codes)
    bits = np.ones((len(v), -(-(length + 63) // 8) * 8), np.uint8)
    bits[:, :length] = [code >> (length - 1 - i) & 1 for i in range(length)]
    bits[:, length : length + 63] = np.abs(v[:, 1:]) & 1
    return np.packbits(bits, axis=1).ravel(), np.full(len(v), bits.shape[1] // 8, np.int64)


def _framed(coded: tuple[np.ndarray, np.ndarray], turn: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks' whole bytes stuffed, and restart markers between them; and bytes for each block."""
    raw, whole = coded
    n = len(whole)
    at = np.cumsum(whole) - whole
    full = np.flatnonzero(raw == 0xFF)
    after = np.where(final, 0, 2)
    extra = np.searchsorted(full, at + whole) - np.searchsorted(full, at)
    size = whole + extra + after
    # a place's shift is the number of bytes put in before it
    step = np.zeros(len(raw) + 1, np.int32)
    step[at[1:]] = after[:-1]
    step[full + 1] += 1
    out = np.zeros(int(size.sum()), np.uint8)
    out[np.arange(len(raw)) + np.cumsum(step[:-1])] = raw
    mid = np.flatnonzero(~final)
    end = np.cumsum(size)[mid]
    out[end - 2] = 0xFF
    out[end - 1] = 0xD0 + turn[mid] % 8
    return out, size


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + struct.pack(">H", len(body) + 2) + body


SCRIPT = [(0, 0, 0, 1), (1, 20, 0, 1), (21, 63, 0, 1), (1, 63, 1, 0), (0, 0, 1, 0)]


def grid(blocks: int) -> tuple[int, int]:
    """Macroblocks across and down that hold so many blocks, six to each."""
    m = max(1, -(-blocks // 6))
    across = -(-m // 4095)
    return across, -(-m // across)


def write(coefficients: np.ndarray, blocks: np.ndarray, notes: list[bytes]) -> list[bytes]:
    """A file for each run of blocks (rows of 64 coefficients in zigzag order, below 1024 in magnitude), with a comment.

    A run fills the luma blocks first, then the two chroma planes; what is left of a plane is zero.
    """
    sizes = [grid(int(b)) for b in blocks]
    cells = np.array([w * h for w, h in sizes], np.int64)
    share = [np.minimum(blocks, 4 * cells), None, None]
    share[1] = np.minimum(blocks - share[0], cells)
    share[2] = blocks - share[0] - share[1]
    start = np.cumsum(blocks) - blocks
    parts: list[list[bytes]] = [[] for _ in blocks]
    quant = _segment(DQT, bytes([0]) + bytes([1] * 64))
    tables = _segment(DHT, bytes([0x00, *DC_CODE.counts]) + DC_CODE.symbols + bytes([0x10, *AC_CODE.counts]) + AC_CODE.symbols)
    for i, (w, h) in enumerate(sizes):
        frame = struct.pack(">BHHB", 8, 16 * h, 16 * w, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
        parts[i].append(bytes([0xFF, SOI]) + _segment(COM, notes[i]) + quant + _segment(SOF2, frame) + tables + _segment(DRI, struct.pack(">H", 1)))
    for c in range(3):
        planes = cells * (4 if c == 0 else 1)
        v = np.zeros((int(planes.sum()), 64), np.int16)
        at = np.cumsum(planes) - planes
        v[repeat_ranges(at, share[c])] = coefficients[repeat_ranges(start + sum(share[:c], np.zeros_like(start)), share[c])]
        turn = repeat_ranges(np.zeros(len(planes), np.int64), planes)
        final = turn == np.repeat(planes, planes) - 1
        v[repeat_ranges(at + share[c], planes - share[c])] = 2  # no coefficient of a block that only fills up is small
        for ss, se, ah, al in SCRIPT:
            make = {(0, 0): _dc_first, (0, 1): _dc_refine, (1, 1): _ac_refine}.get((int(ss > 0), ah)) or (lambda x, a=ss, b=se: _ac_first(x, a, b))
            if ah and _all_old(v):
                out, size = _framed(_refine_bytes(v, ss), turn, final)
            else:
                out, size = _entropy(*make(v), turn, final)
            ends = np.concatenate([[0], np.cumsum(np.add.reduceat(size, at))])
            raw = out.tobytes()
            head = _segment(SOS, bytes([1, c + 1, 0x00, ss, se, ah << 4 | al]))
            for i in range(len(blocks)):
                parts[i].append(head)
                parts[i].append(raw[ends[i] : ends[i + 1]])
    return [b"".join(x) + bytes([0xFF, EOI]) for x in parts]


# --- reading ---------------------------------------------------------------------------------------


@dataclass
class Scan:
    components: tuple[int, ...]
    dc: tuple[Huffman | None, ...]
    ac: tuple[Huffman | None, ...]
    ss: int
    se: int
    ah: int
    al: int
    restart: int
    start: int = 0
    end: int = 0

    @property
    def quick(self) -> np.ndarray:
        return self.ac[0].whole


@dataclass
class Image:
    height: int = 0
    width: int = 0
    factors: list[tuple[int, int]] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    quant: list[int] = field(default_factory=list)
    tables: dict[int, np.ndarray] = field(default_factory=dict)
    scans: list[Scan] = field(default_factory=list)
    note: bytes = b""
    planes: list[np.ndarray] = field(default_factory=list)

    def mcus(self) -> tuple[int, int]:
        h, v = max(f[0] for f in self.factors), max(f[1] for f in self.factors)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))

    def blocks(self, c: int) -> tuple[int, int]:
        """Blocks across and down that component c stores, with those that only fill up macroblocks."""
        w, h = self.mcus()
        return w * self.factors[c][0], h * self.factors[c][1]

    def order(self, scan: Scan) -> tuple[np.ndarray, np.ndarray]:
        """Component (by place in the scan) and block of each data unit in coding order."""
        return _order(self.width, self.height, tuple(self.factors), scan.components)

    def units(self, components: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        if len(components) == 1:
            c = components[0]
            h, v = max(f[0] for f in self.factors), max(f[1] for f in self.factors)
            across = -(-(-(-self.width * self.factors[c][0] // h)) // 8)
            down = -(-(-(-self.height * self.factors[c][1] // v)) // 8)
            at = (np.arange(down)[:, None] * self.blocks(c)[0] + np.arange(across)).ravel()
            return np.zeros(len(at), np.int64), at
        w, h = self.mcus()
        y, x = np.divmod(np.arange(w * h), w)
        comp, block = [], []
        for k, c in enumerate(components):
            fx, fy = self.factors[c]
            for i in range(fy):
                for j in range(fx):
                    comp.append(np.full(w * h, k))
                    block.append((y * fy + i) * (w * fx) + x * fx + j)
        return np.stack(comp, 1).ravel(), np.stack(block, 1).ravel()


@functools.lru_cache(maxsize=512)
def _order(width: int, height: int, factors: tuple, components: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    return Image(height, width, list(factors)).units(components)


@functools.lru_cache(maxsize=256)
def _huffman(counts: tuple[int, ...], symbols: bytes) -> Huffman:
    return Huffman(counts, symbols)


def parse(data: bytes, start: int, end: int, stops: np.ndarray) -> Image:
    """Headers and scans of the file at data[start:end]; stops: places of all markers that can end entropy-coded data."""
    image, dc, ac, restart = Image(), {}, {}, 0
    if data[start : start + 2] != bytes([0xFF, SOI]):
        raise MediaError("not a JPEG file")
    at = start + 2
    while at < end:
        if data[at] != 0xFF:
            raise MediaError("no marker where one must be")
        marker = data[at + 1]
        if marker == EOI:
            break
        if marker == 0xFF:
            at += 1
            continue
        size = struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == DQT:
            while body:
                wide, key = body[0] >> 4, body[0] & 15
                n = 64 * (1 + wide)
                image.tables[key] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[1 + n :]
        elif marker == DHT:
            while body:
                counts = tuple(body[1:17])
                n = sum(counts)
                (ac if body[0] >> 4 else dc)[body[0] & 15] = _huffman(counts, bytes(body[17 : 17 + n]))
                body = body[17 + n :]
        elif marker == SOF2:
            bits, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            if bits != 8 or n not in (1, 3) or not image.height or not image.width:
                raise MediaError("only 8-bit grey or three-component images")
            for c in range(n):
                i, f, q = body[6 + 3 * c : 9 + 3 * c]
                image.ids.append(i)
                image.factors.append((f >> 4, f & 15))
                image.quant.append(q)
            image.planes = [np.zeros((int(np.prod(image.blocks(c))), 64), np.int32) for c in range(n)]
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise MediaError("not a progressive Huffman-coded file")
        elif marker == DRI:
            restart = struct.unpack(">H", body)[0]
        elif marker == COM:
            image.note = bytes(body)
        elif marker == SOS:
            n = body[0]
            comps = tuple(image.ids.index(body[1 + 2 * k]) for k in range(n))
            tables = [body[2 + 2 * k] for k in range(n)]
            ss, se, a = body[1 + 2 * n : 4 + 2 * n]
            k = int(np.searchsorted(stops, at))
            if k == len(stops) or stops[k] >= end:
                raise MediaError("the file has no end")
            until = int(stops[k])
            image.scans.append(Scan(comps, tuple(dc.get(t >> 4) for t in tables), tuple(ac.get(t & 15) for t in tables), ss, se, a >> 4, a & 15, restart, at, until))
            at = until
    else:
        raise MediaError("the file has no end")
    return image


class Lanes:
    """Bit readers over segments of clean entropy-coded bytes, moved in lockstep."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray):
        full = np.concatenate([raw, np.zeros(16, np.uint8)])
        self.bits = full
        n = len(raw) + 8
        self.words = np.zeros(n, np.uint64)
        for k in range(8):
            self.words |= full[k : k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
        self.at = starts * 8
        self.last = len(raw)

    def peek(self, rows) -> np.ndarray:
        at = self.at[rows]
        if len(at) and int(at.max()) >> 3 > self.last:
            raise MediaError("entropy-coded data ends early")
        return self.words[at >> 3] << (at & 7).astype(np.uint64)

    def symbol(self, rows, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next symbol of each lane and the 64 bits behind it (at least 41 of them are there)."""
        x = self.peek(rows)
        found = table[(x >> np.uint64(48)).astype(np.int64)]
        length = found >> 8
        if len(length) and not length.all():
            raise MediaError("no such Huffman code")
        self.at[rows] += length
        return found & 255, x << length.astype(np.uint64)

    def take(self, rows, ahead: np.ndarray, n: np.ndarray) -> np.ndarray:
        self.at[rows] += n
        return (ahead >> np.uint64(1) >> (63 - n).astype(np.uint64)).astype(np.int64)

    def bit(self, rows) -> np.ndarray:
        x = self.peek(rows) >> np.uint64(63)
        self.at[rows] += 1
        return x.astype(np.int64)


def _extend(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where((s > 0) & (v < (1 << np.maximum(s - 1, 0))), v - (1 << s) + 1, v)


def _ac_first_block(lanes: Lanes, rows: np.ndarray, eob: np.ndarray, scan: Scan, table: np.ndarray, out: np.ndarray, blocks: np.ndarray) -> None:
    run = eob[rows] > 0
    eob[rows[run]] -= 1
    rows, blocks = rows[~run], blocks[~run]
    k = np.full(len(rows), scan.ss)
    flat, quick = out.reshape(-1), scan.quick
    while len(rows):
        # as long as every lane's next symbols lie whole in what one look ahead shows, three are read at a time
        base, at, go = blocks * 64, lanes.at[rows], True
        while go and len(rows) and int(k.max()) + 3 <= scan.se + 1 and int(at.max()) >> 3 <= lanes.last:
            x = lanes.words[at >> 3] << (at & 7).astype(np.uint64)
            for _ in range(3):
                e = quick[(x >> np.uint64(48)).astype(np.int64)]
                n = e >> 20
                to = k + (e >> 16 & 15)
                if not n.all() or int(to.max()) > scan.se:
                    go = False
                    break
                flat[base + to] = e.astype(np.int16).astype(np.int32) << scan.al
                k = to + 1
                at = at + n
                x = x << n.astype(np.uint64)
            if int(k.max()) > scan.se:
                break
        lanes.at[rows] = at
        left = k <= scan.se
        if not left.all():
            rows, blocks, k = rows[left], blocks[left], k[left]
            continue
        symbol, ahead = lanes.symbol(rows, table)
        r, s = symbol >> 4, symbol & 15
        stop = (s == 0) & (r < 15)
        value = lanes.take(rows, ahead, np.where(stop, r, s))
        if stop.any():
            eob[rows[stop]] = (1 << r[stop]) + value[stop] - 1
        k = k + r
        put = s > 0
        if (k[~stop] > scan.se).any():
            raise MediaError("a run leaves its band")
        out[blocks[put], k[put]] = _extend(value[put], s[put]) << scan.al
        k += 1
        go = ~stop & (k <= scan.se)
        if not go.all():
            rows, blocks, k = rows[go], blocks[go], k[go]


def _ac_refine_block(lanes: Lanes, rows: np.ndarray, eob: np.ndarray, scan: Scan, table: np.ndarray, out: np.ndarray, blocks: np.ndarray) -> None:
    one = 1 << scan.al
    begin = np.full(len(rows), scan.ss)  # where a lane's end-of-band stretch begins
    live = np.flatnonzero(eob[rows] == 0)
    state = np.zeros(len(rows), np.int64)  # 0: a symbol is due, 1: advancing
    left, value = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for k in range(scan.ss, scan.se + 1):
        due = live[state[live] == 0]
        if len(due):
            symbol, ahead = lanes.symbol(rows[due], table)
            r, s = symbol >> 4, symbol & 15
            stop = (s == 0) & (r < 15)
            more = lanes.take(rows[due], ahead, np.where(stop, r, (s > 0).astype(np.int64)))
            eob[rows[due[stop]]] = (1 << r[stop]) + more[stop]
            begin[due[stop]] = k
            left[due], value[due], state[due] = r, np.where(s > 0, np.where(more > 0, one, -one), 0), 1
            if stop.any():
                live = live[eob[rows[live]] == 0]
        if not len(live):
            break
        here = out[blocks[live], k]
        old = live[here != 0]
        if len(old):
            add = lanes.bit(rows[old]) * one
            now = out[blocks[old], k]
            out[blocks[old], k] = now + np.sign(now) * add
        new = live[here == 0]
        done = new[left[new] == 0]
        out[blocks[done], k] = value[done]
        state[done] = 0
        left[new] -= 1
    tail = np.flatnonzero(eob[rows] > 0)
    if len(tail):
        band = out[blocks[tail], scan.ss : scan.se + 1]
        if band.shape[1] <= 64 and (begin[tail] == scan.ss).all() and band.all():
            at = lanes.at[rows[tail]]
            if int(at.max()) + band.shape[1] >> 3 > lanes.last:
                raise MediaError("entropy-coded data ends early")
            look = [(lanes.words[a >> 3] << (a & 7).astype(np.uint64)) >> np.uint64(32) for a in (at, at + 32)]
            bit = np.unpackbits((look[0] << np.uint64(32) | look[1]).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, : band.shape[1]]
            out[blocks[tail], scan.ss : scan.se + 1] = band + np.where(band < 0, -one, one).astype(np.int32) * bit
            lanes.at[rows[tail]] += band.shape[1]
            eob[rows[tail]] -= 1
            return
        old = (band != 0) & (np.arange(scan.ss, scan.se + 1) >= begin[tail][:, None])
        n = old.sum(1)
        at = lanes.at[rows[tail]][:, None] + np.cumsum(old, 1) - old
        hit = at[old]
        if len(hit) and int(hit.max()) >> 3 > lanes.last:
            raise MediaError("entropy-coded data ends early")
        bit = (lanes.bits[hit >> 3] >> (7 - (hit & 7)).astype(np.uint8)) & 1
        own = band[old]
        band[old] = own + np.sign(own) * (bit.astype(np.int32) * one)
        out[blocks[tail], scan.ss : scan.se + 1] = band
        lanes.at[rows[tail]] += n
        eob[rows[tail]] -= 1


def _decode_scans(group: list[tuple[Image, Scan]], data: np.ndarray, marks: tuple[np.ndarray, np.ndarray]) -> None:
    """Scans of equal parameters and codes, of several files, all lanes together."""
    scan = group[0][1]
    places, kinds = marks
    images = [image for image, _ in group]
    starts, ends = (np.array(x, np.int64) for x in zip(*((s.start, s.end) for _, s in group), strict=True))
    size = ends - starts
    base = np.cumsum(size) - size
    raw = data[repeat_ranges(starts, size)]
    lo, hi = np.searchsorted(places, starts), np.searchsorted(places, ends)
    inner = repeat_ranges(lo, hi - lo)
    place = places[inner] + np.repeat(base - starts, hi - lo)
    rst = kinds[inner] != 0
    keep = np.ones(len(raw), bool)
    keep[place[~rst] + 1] = False
    keep[place[rst]] = keep[place[rst] + 1] = False
    clean = np.append(np.cumsum(keep) - keep, int(keep.sum()))
    found = np.bincount(np.repeat(np.arange(len(group)), hi - lo)[rst], minlength=len(group))
    lanes = Lanes(raw[keep], clean[np.sort(np.concatenate([base, place[rst]]))])
    lane_units, comps, blocks, bases = [], [], [], []
    at = np.zeros(len(scan.components), np.int64)
    for k, (image, s) in enumerate(group):
        comp, block = image.order(s)
        per = len(comp) if not s.restart else s.restart * (1 if len(s.components) == 1 else sum(image.factors[c][0] * image.factors[c][1] for c in s.components))
        want = max(1, -(-len(comp) // per))
        if found[k] != want - 1:
            raise MediaError("restart markers do not fit the image")
        lane_units.append(np.full(want, per))
        lane_units[-1][-1] = len(comp) - per * (want - 1)
        comps.append(comp)
        blocks.append(block + at[comp] if len(at) > 1 else block + at[0])
        bases.append(at.copy())
        at += [len(image.planes[c]) for c in s.components]
    units = np.concatenate(lane_units)
    first = np.cumsum(units) - units
    comp, block = np.concatenate(comps), np.concatenate(blocks)
    outs = [np.concatenate([image.planes[s.components[k]] for image, s in group]) for k in range(len(scan.components))]
    eob = np.zeros(len(units), np.int64)
    pred = np.zeros((len(units), len(outs)), np.int64)
    for u in range(int(units.max())):
        rows = np.flatnonzero(units > u)
        unit = first[rows] + u
        for k, out in enumerate(outs):
            mine = comp[unit] == k if len(outs) > 1 else slice(None)
            r, b = rows[mine], block[unit[mine]]
            if not len(r):
                continue
            if scan.ss == 0:
                if scan.ah:
                    out[b, 0] |= (lanes.bit(r) << scan.al).astype(np.int32)
                else:
                    s, ahead = lanes.symbol(r, scan.dc[k].table)
                    pred[r, k] += _extend(lanes.take(r, ahead, s), s)
                    out[b, 0] = pred[r, k] << scan.al
            elif scan.ah:
                _ac_refine_block(lanes, r, eob, scan, scan.ac[k].table, out, b)
            else:
                _ac_first_block(lanes, r, eob, scan, scan.ac[k].table, out, b)
    for (image, s), at in zip(group, bases, strict=True):
        for k, c in enumerate(s.components):
            image.planes[c] = outs[k][at[k] : at[k] + len(image.planes[c])]


def read(files: list[bytes]) -> list[Image]:
    """Coefficients of all files; equal scans of different files are decoded together."""
    raw = b"".join(files)
    data = np.frombuffer(raw, np.uint8)
    full = np.flatnonzero(data[:-1] == 0xFF)
    kind = data[full + 1]
    stops = full[(kind != 0) & (kind != 0xFF) & ((kind < 0xD0) | (kind > 0xD7))]
    inner = full[(kind == 0) | ((kind >= 0xD0) & (kind <= 0xD7))]
    marks = inner, data[inner + 1]
    images, at = [], 0
    for f in files:
        images.append(parse(raw, at, at + len(f), stops))
        at += len(f)
    for step in range(max((len(x.scans) for x in images), default=0)):
        groups: dict[tuple, list] = {}
        for image in images:
            if step < len(image.scans):
                s = image.scans[step]
                groups.setdefault((s.components, s.dc, s.ac, s.ss, s.se, s.ah, s.al), []).append((image, s))
        for group in groups.values():
            _decode_scans(group, data, marks)
    return images


@functools.lru_cache(maxsize=1)
def basis() -> np.ndarray:
    """64 x 64: samples of each zigzag coefficient's cosine product, as integers of BASIS_BITS fractional bits."""
    x = np.arange(8)
    c = np.array([[(np.sqrt(0.125) if u == 0 else 0.5) * np.cos((2 * i + 1) * u * np.pi / 16) for i in x] for u in x])
    return np.round(np.array([np.outer(c[r], c[k]).ravel() for r, k in ZIGZAG]) * (1 << BASIS_BITS))


def samples(coefficients: np.ndarray) -> np.ndarray:
    """8 x 8 samples of each row of dequantised coefficients: sums of integers below 2**53, so no order of adding changes them."""
    out = np.empty((len(coefficients), 64), np.uint8)
    for i in range(0, len(out), 8192):
        x = coefficients[i : i + 8192].astype(np.float64) @ basis()
        x += (128 << BASIS_BITS) + (1 << (BASIS_BITS - 1))
        x *= 1 / (1 << BASIS_BITS)
        out[i : i + 8192] = np.clip(np.floor(x, out=x), 0, 255, out=x)
    return out.reshape(-1, 8, 8)


def tensor(image: Image, planes: list[np.ndarray] | None = None) -> np.ndarray:
    """Height x width x 3, full resolution."""
    top = [max(f[k] for f in image.factors) for k in (0, 1)]
    if planes is None:
        planes = [samples(image.planes[c] * image.tables[image.quant[c]]) for c in range(len(image.planes))]
    full = []
    for c, p in enumerate(planes):
        across, down = image.blocks(c)
        plane = p.reshape(down, across, 8, 8).swapaxes(1, 2).reshape(down * 8, across * 8)
        rx, ry = top[0] // image.factors[c][0], top[1] // image.factors[c][1]
        full.append(plane.repeat(ry, 0).repeat(rx, 1)[: image.height, : image.width].astype(np.int32))
    if len(full) == 1:
        return np.repeat(full[0].astype(np.uint8)[:, :, None], 3, 2)
    y, cb, cr = full[0] << 16, full[1] - 128, full[2] - 128
    half = 1 << 15  # fixed values: the colour matrix in 16 fractional bits
    rgb = [y + 91881 * cr + half, y - 22554 * cb - 46802 * cr + half, y + 116130 * cb + half]
    return np.stack([np.clip(x >> 16, 0, 255).astype(np.uint8) for x in rgb], 2)


# --- columns ---------------------------------------------------------------------------------------


@functools.lru_cache(maxsize=1)
def swapped() -> np.ndarray:
    """The byte whose place each byte takes; the table is its own inverse."""
    out = np.arange(256, dtype=np.uint8)
    out[[0x7F, 0x80, 0x81]], out[[0xFD, 0xFE, 0xFF]] = [0xFD, 0xFE, 0xFF], [0x7F, 0x80, 0x81]
    return out


def payload_coefficients(raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts' bytes as rows of 64 coefficients, zero bytes at each end up to a positive multiple of 64; blocks of each."""
    blocks = np.maximum(1, (size + 63) // 64)
    flat = np.zeros(int(blocks.sum()) * 64, np.uint8)
    start = (np.cumsum(blocks) - blocks) * 64
    flat[repeat_ranges(start, size)] = raw
    return swapped()[flat].reshape(-1, 64).astype(np.int16) - 128, blocks


def payload_of(image: Image, blocks: int) -> np.ndarray:
    rows = np.concatenate(image.planes)[:blocks] if len(image.planes[0]) < blocks else image.planes[0][:blocks]
    return swapped()[(rows + 128).astype(np.uint8).ravel()]


def feature(pixels: np.ndarray) -> str:
    """Mean and spread of each channel, and a digest of the tensor."""
    flat = pixels.reshape(-1, 3)
    square = [int(np.square(flat[:, c], dtype=np.uint16).sum(dtype=np.int64)) for c in range(3)]
    total = flat.sum(0, dtype=np.int64)
    n = len(flat)
    parts = [f"{int(t) * 1000 // n}/{(int(q) * n - int(t) ** 2) * 1000 // (n * n)}" for t, q in zip(total, square, strict=True)]
    return f"{pixels.shape[1]}x{pixels.shape[0]}:" + ",".join(parts) + f":{zlib.crc32(np.ascontiguousarray(pixels)):08x}"


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the progressive file (media) that holds each text's padded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_view(batch.column(1))
            for i, j in text_chunks(offsets, BYTES):
                size = np.diff(offsets[i : j + 1])
                v, blocks = payload_coefficients(data[offsets[i] : offsets[j]], size)
                files = write(v, blocks, [struct.pack(">Q", int(n)) for n in size])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(size), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def load(stored: DataFrame, with_tensor: bool = False) -> DataFrame:
    """Files (doc_id, media) of store() read back: n_bytes, payload, media, feature and, if wanted, the RGB tensor with its height and width."""
    more = ", height int, width int, tensor binary" if with_tensor else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, files = 0, batch.column(1)
            while at < len(batch):
                took, size = [], 0
                while at + len(took) < len(batch) and (not took or size < 2 * BYTES):
                    took.append(files[at + len(took)].as_py())
                    size += len(took[-1])
                images = read(took)
                rows = []
                shown = [samples(np.concatenate([x.planes[c] * x.tables[x.quant[c]] for x in images])) for c in range(3)]
                ends = [np.concatenate([[0], np.cumsum([len(x.planes[c]) for x in images])]) for c in range(3)]
                for k, (image, f) in enumerate(zip(images, took, strict=True)):
                    n = struct.unpack(">Q", image.note)[0]
                    pixels = tensor(image, [shown[c][ends[c][k] : ends[c][k + 1]] for c in range(3)])
                    row = [n, payload_of(image, max(1, -(-n // 64))).tobytes(), f, feature(pixels)]
                    rows.append(row + ([image.height, image.width, pixels.tobytes()] if with_tensor else []))
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
                cols = [pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(took)), *cols], names=["doc_id", "n_bytes", "payload", "media", "feature", "height", "width", "tensor"][: 1 + len(cols)])
                at += len(took)

    return stored.select("doc_id", "media").mapInArrow(run, "doc_id long, n_bytes long, payload binary, media binary, feature string" + more)


def op9_progressive_jpeg(spark, sf_dir: str) -> DataFrame:
    """Every text stored in a progressive file and read back."""
    from .common import documents

    stored = store(documents(spark, sf_dir))
    back = load(stored)
    tail = F.substring(F.col("payload"), -64, 64)
    return back.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )
