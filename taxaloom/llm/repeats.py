"""Suffix-array dedup: bytes covered by a long string that also starts earlier are removed.

A byte goes if some window of `length` bytes over it has a longest previous factor (LPF) of `length`
or more: the longest string from its start that also starts earlier. LPF comes from suffix order: of
all suffixes with an earlier start, the ones that share the longest beginning are the previous smaller
position (the last one before in suffix order with a smaller start) and the next smaller one, and what
is shared is the least common prefix of neighbours on the way (previous_factors()).

Only suffixes that can have such a factor are brought into order. Each window of `length` bytes has an
anchor, its leftmost smallest 32-gram, so equal windows have equal anchors at equal places. The
windows of one anchor are its neighbourhood. Equal neighbourhoods get one name (two fingerprints of
64 bits), and of those with one name, whose suffixes are neighbours in any order, all but the first
have an earlier one. What is left, differing neighbourhoods of one 32-gram, is sent with its bytes; the
suffixes of a 32-gram's neighbourhoods meet in one task, which orders them by their bytes (prefix
doubling), with common prefixes, smaller positions and LPF. A 32-gram with very many differing
neighbourhoods would be too much for a task: its windows are named one by one and dealt by name. Each
batch is settled by itself before the shuffle and sends one suffix for each name, so a string in a
third of all documents costs a reducer one row per batch.

Defined results. A null or empty text has no bytes. A text shorter than `length` loses nothing. Rows
with a null doc_id come last. Rows of one doc_id (or of none) with different texts are different
documents, in the order of a hash of their texts. Equal rows stand at one place, so neither is earlier
than the other, and both get the same result. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK, byte_table, doc_key, fresh, materialise, mix64, partitions, repeat_ranges, text_chunks, utf8_view

K = 32
#: Bytes of text whose anchors are ordered together before the shuffle.
FLUSH = 12_000_000
#: Anchors that are ordered together at most: prose has one in 23 bytes, a run of one byte has one in each.
HELD = 1_000_000
#: Rows that go to the JVM at once.
SENT = 100_000
#: Differing neighbourhoods of one 32-gram that a single task compares; beyond it, windows are dealt one by one.
HOT = 4096
SPREAD = 32
ROWS = pa.schema([("k", pa.int64()), ("x", pa.int64()), ("doc", pa.int64()), ("d", pa.int64()), ("sw", pa.int64())])
ROWS_SQL = "k long, x long, doc long, d long, sw long"
MARKS = pa.schema([("f", pa.int8()), ("doc", pa.int64()), ("d", pa.int64()), ("s", pa.int32()), ("w", pa.int32()), ("h", pa.int64())])
MARKS_SQL = "f tinyint, doc long, d long, s int, w int, h long"
WINDOWS = pa.schema([("k", pa.int64()), ("f", pa.int8()), ("x", pa.int64()), ("doc", pa.int64()), ("d", pa.int64()), ("s", pa.int32()), ("w", pa.int32()), ("b", pa.binary())])
WINDOWS_SQL = "k long, f tinyint, x long, doc long, d long, s int, w int, b binary"
#: Kinds of rows: an occurrence dealt by its 32-gram; one dealt by its neighbourhood; a note that a 32-gram has several neighbourhoods; a settled mark.
BY_GRAM, BY_CONTEXT, NOTE, MARK = 0, 1, 2, 3
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def _padded(data: np.ndarray, offsets: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes with `pad` codes of 256 before each text and after the last; where each text starts."""
    lengths = np.diff(offsets)
    starts = offsets[:-1] - offsets[0] + pad * np.arange(1, len(lengths) + 1)
    codes = np.full(int(lengths.sum()) + pad * (len(lengths) + 1), 256, np.uint16)
    codes[repeat_ranges(starts, lengths)] = data[offsets[0] : offsets[-1]]
    return codes, starts


def _grams(codes: np.ndarray, seed: int, top: int) -> dict[int, np.ndarray]:
    """Hashes of the 1, 2, 4, ... top codes from each place; beyond the end they are cut short alike."""
    out = {1: byte_table(seed)[codes]}
    size = 1
    while size < top:
        a = out[size]
        b = a * ODD[size.bit_length() - 1]
        b[:-size] += a[size:]
        out[2 * size] = b
        if size not in (4, 32):
            del out[size]
        size *= 2
    return out


def _anchors(codes: np.ndarray, grams: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor: its place, and the first and last window that has it."""
    width = length - K + 1
    v = (mix64(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(codes), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        v = np.minimum(v[: len(v) - span], v[span:])
        span *= 2
    if span < width:
        v = np.minimum(v[: len(v) - (width - span)], v[width - span :])
    counts = np.maximum(lengths - length + 1, 0)
    s = repeat_ranges(starts, counts)
    if not len(s):
        return s, s, s
    p = (v[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    last = np.concatenate([first[1:], [len(s)]]) - 1
    return p[first], s[first], s[last]


def _contexts(g64: np.ndarray, lo: np.ndarray, hi: np.ndarray, p: np.ndarray, length: int) -> np.ndarray:
    """Hash of all bytes of the windows lo..hi of an anchor, and of where the anchor stands in them."""
    end = hi + length
    x = g64[lo] * ODD[1] + g64[(lo + end - 64) >> 1] * ODD[2] + g64[end - 64] * ODD[3]
    return mix64(x + ((hi - lo) * 4096 + (p - lo)).astype(np.uint64) * ODD[4])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def _rows(f: np.ndarray, k: np.ndarray, x: np.ndarray, doc: np.ndarray, d: np.ndarray, s: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    """Start, width and kind share one word: 32, 30 and 2 bits."""
    sw = (s.astype(np.int64) << 32) | (w.astype(np.int64) << 2) | f
    return pa.RecordBatch.from_arrays([pa.array(y.astype(np.int64, copy=False)) for y in (k, x, doc, d, sw)], schema=ROWS)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys: whether each row begins a run."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def later_copies(new: np.ndarray, doc: np.ndarray, d: np.ndarray, s: np.ndarray) -> np.ndarray:
    """For runs of equal beginnings with places ascending: whether the run's first place, the previous smaller one, is smaller than a row's own."""
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return (doc[head] != doc) | (d[head] != d) | (s[head] != s)


def _smaller(place: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """For each suffix in order: the prefix shared with the nearest one before that has a smaller place; common[i] is that of i - 1 and i.

    All suffixes look one step back at once; one that finds no smaller place goes on from where that
    one is by now. Nobody looks on once fewer than `least` bytes are shared.
    """
    to = np.arange(-1, len(place) - 1)
    shared = common.copy()
    on = np.arange(1, len(place))
    while len(on):
        on = on[(shared[on] >= least) & (to[on] >= 0)]
        on = on[place[to[on]] >= place[on]]
        at = to[on]
        shared[on], to[on] = np.minimum(shared[on], shared[at]), to[at]
    return np.where((to >= 0) & (place[to] < place), shared, 0)


def previous_factors(data: np.ndarray, at: np.ndarray, place: np.ndarray, length: int, least: int = 1) -> np.ndarray:
    """For suffixes at data[at:]: how many bytes, `length` at most, each shares with one at a smaller place.

    Values below `least` may come out smaller. Each suffix has `length` bytes at least.
    """
    if not len(at):
        return np.zeros(0, np.int64)
    x = np.concatenate([data, np.zeros(length + 64, np.uint8)]).astype(np.uint64)
    for i in (1, 2, 4):  # eight bytes as one number whose order is theirs
        x = (x[:-i] << np.uint64(8 * i)) | x[i:]
    ranks = {8: np.unique(x, return_inverse=True)[1]}
    size = 8
    while 2 * size <= length:  # prefix doubling: ranks by twice as many bytes
        r = ranks[size]
        ranks[2 * size] = np.unique((r[:-size] << 32) | r[size:], return_inverse=True)[1]
        size *= 2
    whole = (ranks[size][at] << 32) | ranks[size][at + length - size]
    order = np.lexsort((place, whole))
    whole, at, place = whole[order], at[order], place[order]
    common = np.zeros(len(at), np.int64)
    a, b = at[:-1].copy(), at[1:].copy()
    for k in sorted(ranks, reverse=True):
        same = ranks[k][a] == ranks[k][b]
        a[same] += k
        b[same] += k
    for k in (4, 2, 1):
        shift = np.uint64(64 - 8 * k)
        same = x[a] >> shift == x[b] >> shift
        a[same] += k
        b[same] += k
    common[1:] = np.where(whole[1:] == whole[:-1], length, a - at[:-1])
    before = _smaller(place, common, least)
    after = _smaller(place[::-1], np.append(0, common[:0:-1]), least)[::-1]
    out = np.empty(len(at), np.int64)
    out[order] = np.maximum(before, after)
    return out


def places(doc: np.ndarray, d: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Numbers in the order of places; equal ones share a number."""
    order = np.lexsort((s, d, doc))
    out = np.empty(len(s), np.int64)
    out[order] = np.cumsum(_runs(doc[order], d[order], s[order]))
    return out


def merged(doc: np.ndarray, d: np.ndarray, s: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of window starts s..s+w of each document, those that touch made one."""
    if not len(doc):
        return doc, d, s, w
    order = np.lexsort((s, d, doc))
    doc, d, s, e = doc[order], d[order], s[order].astype(np.int64), (s[order].astype(np.int64) + w[order])
    new = _runs(doc, d)
    lift = np.cumsum(new) * (int(e.max()) + 2)  # ends of a document never reach into the next one
    reach = np.maximum.accumulate(e + lift)
    new[1:] |= s[1:] + lift[1:] > reach[:-1] + 1
    head = np.flatnonzero(new)
    end = reach[np.concatenate([head[1:], [len(doc)]]) - 1] - lift[head]
    return doc[head], d[head], s[head], end - s[head]


def _by_row(doc: np.ndarray, d: np.ndarray) -> np.ndarray:
    return _signed(mix64(doc.astype(np.uint64) ^ d.view(np.uint64)))


def _local(h: np.ndarray, c: np.ndarray, doc: np.ndarray, d: np.ndarray, s: np.ndarray, w: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Order one batch's anchors; pass on the first of each neighbourhood and marks for the rest."""
    order = np.lexsort((s, d, doc, c, h))
    h, c, doc, d, s, w = (x[order] for x in (h, c, doc, d, s, w))
    new_h, new = _runs(h), _runs(h, c)
    late = later_copies(new, doc, d, s)
    many = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_h)) > 1
    flagged = np.repeat(many, np.diff(np.append(np.flatnonzero(new_h), len(h))))
    fl, zero = flagged[new], np.zeros(len(h), np.int64)
    yield _rows(fl.astype(np.int64), np.where(fl, c[new], h[new]), np.where(fl, h[new], c[new]), doc[new], d[new], s[new], w[new])
    note = new_h & flagged
    if note.any():
        yield _rows(np.full(int(note.sum()), NOTE), h[note], zero[note], doc[note], d[note], zero[note], zero[note])
    if late.any():
        doc, d, a, b = merged(doc[late], d[late], s[late], w[late])
        yield _rows(np.full(len(d), MARK), _by_row(doc, d), np.zeros(len(d), np.int64), doc, d, a, b)


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """First row, where in its text, and offsets: rows of CHUNK bytes together, or a stretch of CHUNK window starts of a long text.

    A run of windows with one anchor that is cut in two is settled window by window.
    """
    for i, j in text_chunks(offsets):
        n = int(offsets[j] - offsets[i])
        if j - i > 1 or n <= 4 * CHUNK:
            yield i, 0, offsets[i : j + 1]
            continue
        for a in range(0, n - length + 1, CHUNK):
            yield i, a, offsets[i] + np.array([a, min(a + CHUNK + length - 1, n)])


def anchor_rows(length: int, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = rows = 0

        def local() -> Iterator[pa.RecordBatch]:
            found = _local(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            for batch in found:
                yield from (batch.slice(at, SENT) for at in range(0, batch.num_rows, SENT))

        for batch in batches:
            data, offsets = utf8_view(batch.column(2))
            docs, digests = (batch.column(x).to_numpy(zero_copy_only=False) for x in (0, 1))
            for i, a, off in _pieces(offsets, length):
                lengths = np.diff(off)
                size += int(lengths.sum())
                if (lengths >= length).any():
                    codes, starts = _padded(data, off, length)
                    g = _grams(codes, 1, 64)
                    p, lo, hi = _anchors(codes, g[32], starts, lengths, length)
                    own = np.searchsorted(starts, lo, side="right") - 1
                    held.append((_signed(mix64(g[32][p])), _signed(_contexts(g[64], lo, hi, p, length)), docs[i + own], digests[i + own], (lo - starts[own] + a).astype(np.int32), (hi - lo).astype(np.int32)))
                    rows += len(p)
                if held and (size >= flush or rows >= HELD):
                    yield from local()
                    size = rows = 0
        if held:
            yield from local()

    return run


def by_key(batches: Iterator[pa.RecordBatch], settle) -> Iterator[pa.RecordBatch]:
    """Feed settle() with batches sorted by k, each key's rows whole."""
    rest = None
    for batch in batches:
        cols = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        if not len(cols[0]):
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1], side="left"))
        if cut:
            yield from settle(*(x[:cut] for x in cols))
        rest = [x[cut:] for x in cols]
    if rest is not None and len(rest[0]):
        yield from settle(*rest)


def _marks(f: int, doc: np.ndarray, d: np.ndarray, s: np.ndarray, w: np.ndarray, h: np.ndarray | None = None) -> pa.RecordBatch:
    h = np.zeros(len(doc), np.int64) if h is None else h
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), f, np.int8)), pa.array(doc.astype(np.int64)), pa.array(d.astype(np.int64)), pa.array(s.astype(np.int32)), pa.array(w.astype(np.int32)), pa.array(h)], schema=MARKS)


def settle_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks (f = MARK) for neighbourhoods that occur earlier; window ranges (f = BY_CONTEXT) for the first of those whose 32-gram has others."""

    def settle(k, x, doc, d, sw):
        f, s, w = sw & 3, sw >> 32, (sw >> 2) & 0x3FFFFFFF
        done = f == MARK
        if done.any():
            yield _marks(MARK, doc[done], d[done], s[done], w[done])
        noted = np.unique(k[f == NOTE])
        live = f < NOTE
        k, x, doc, d, s, w, f = (y[live] for y in (k, x, doc, d, s, w, f))
        if not len(k):
            return
        flip = f == BY_CONTEXT
        h, c = np.where(flip, x, k), np.where(flip, k, x)
        order = np.lexsort((s, d, doc, c, h))
        h, c, doc, d, s, w, f = (y[order] for y in (h, c, doc, d, s, w, f))
        new_h, new = _runs(h), _runs(h, c)
        late = later_copies(new, doc, d, s)
        if late.any():
            yield _marks(MARK, doc[late], d[late], s[late], w[late])
        heads = np.flatnonzero(new_h)
        several = np.add.reduceat(new.astype(np.int64), heads) > 1
        several |= np.isin(h[heads], noted)
        several |= np.maximum.reduceat(f, heads) == BY_CONTEXT
        edge = new & np.repeat(several, np.diff(np.append(heads, len(h))))
        if edge.any():
            yield _marks(BY_CONTEXT, doc[edge], d[edge], s[edge], w[edge], h[edge])

    yield from by_key(batches, settle)


def _prints(codes: np.ndarray, here: np.ndarray, length: int) -> list[np.ndarray]:
    """Two independent fingerprints of the `length` bytes from each place."""
    out = []
    for seed in (2, 3):
        g = _grams(codes, seed, 64)
        out.append(_signed(mix64(g[64][here] * ODD[1] + g[32][here + 64] * ODD[2] + g[32][here + length - 32] * ODD[3])))
    return out


def _windows(f, k, x, doc, d, s, w, b=None) -> pa.RecordBatch:
    cols = [pa.array(np.asarray(y).astype(t.type.to_pandas_dtype(), copy=False)) for y, t in zip((k, f, x, doc, d, s, w), WINDOWS, strict=False)]
    return pa.RecordBatch.from_arrays([*cols, b if b is not None else pa.nulls(len(doc), pa.binary())], schema=WINDOWS)


def _one_window_each(f1, f2, doc, d, s) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((s, d, doc, f2, f1))
    f1, f2, doc, d, s = (x[order] for x in (f1, f2, doc, d, s))
    new = _runs(f1, f2)
    late = later_copies(new, doc, d, s)
    n = int(new.sum())
    yield _windows(np.full(n, BY_GRAM), f1[new], f2[new], doc[new], d[new], s[new], np.zeros(n, np.int64))
    if late.any():
        doc, d, a, b = merged(doc[late], d[late], s[late], np.zeros(int(late.sum()), np.int64))
        yield _windows(np.full(len(d), MARK), _by_row(doc, d), np.zeros(len(d), np.int64), doc, d, a, b)


def window_rows(key_at: int, digest_at: int, text_at: int, ranges_at: int, length: int):
    """For the ranges that a document brings along: their bytes, dealt by 32-gram, or the fingerprint of each window where the 32-gram is hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            docs, digests = (batch.column(x).to_numpy(zero_copy_only=False) for x in (key_at, digest_at))
            data, offsets = utf8_view(batch.column(text_at))
            ranges = batch.column(ranges_at)
            at = ranges.offsets.to_numpy().astype(np.int64)
            flat = ranges.flatten()
            at = at - at[0]
            rs, rw, rh, hot = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            rs, rw, hot = rs.astype(np.int64), rw.astype(np.int64), hot.astype(bool)
            own = np.repeat(np.arange(len(batch)), np.diff(at))
            cold = np.flatnonzero(~hot)
            step = max(1, CHUNK // (2 * length))  # a range with its bytes is shorter than two lengths
            for part in (cold[at : at + step] for at in range(0, len(cold), step)):
                n = rw[part] + length
                whole = data[repeat_ranges(offsets[own[part]] + rs[part], n)]
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(whole)])
                yield _windows(np.full(len(part), BY_CONTEXT), rh[part], np.zeros(len(part), np.int64), docs[own[part]], digests[own[part]], rs[part], rw[part], blobs)
            if not hot.any():
                continue
            warm = np.flatnonzero(hot)
            for part in np.array_split(warm, max(1, len(warm) // 10_000)):
                n = rw[part] + 1
                whole = n + length - 1
                codes = np.append(data[repeat_ranges(offsets[own[part]] + rs[part], whole)], np.zeros(64, np.uint8)).astype(np.uint16)
                ends = np.cumsum(whole)
                held.append((*_prints(codes, repeat_ranges(ends - whole, n), length), np.repeat(docs[own[part]], n), np.repeat(digests[own[part]], n), repeat_ranges(rs[part], n)))
                size += int(n.sum())
                if size >= 1_000_000:
                    yield from _one_window_each(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, size = [], 0
        if held:
            yield from _one_window_each(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def settle_windows(length: int):
    """Marks for windows with an earlier copy: by name, or by the longest previous factors of the neighbourhoods of a key."""

    def settle(k, f, x, doc, d, s, w, b):
        done = f == MARK
        if done.any():
            yield _marks(MARK, doc[done], d[done], s[done], w[done])
        one = np.flatnonzero(f == BY_GRAM)
        if len(one):
            order = one[np.lexsort((s[one], d[one], doc[one], x[one], k[one]))]
            late = order[later_copies(_runs(k[order], x[order]), doc[order], d[order], s[order])]
            yield _marks(MARK, *merged(doc[late], d[late], s[late], np.zeros(len(late), np.int64)))
        many = np.flatnonzero(f == BY_CONTEXT)
        if len(many):
            n = w[many].astype(np.int64) + 1
            size = n + length - 1
            at = repeat_ranges(np.cumsum(size) - size, n)
            doc, d, s = np.repeat(doc[many], n), np.repeat(d[many], n), repeat_ranges(s[many].astype(np.int64), n)
            late = previous_factors(np.frombuffer(b"".join(b[many]), np.uint8), at, places(doc, d, s), length, length) >= length
            yield _marks(MARK, *merged(doc[late], d[late], s[late], np.zeros(int(late.sum()), np.int64)))

    return lambda batches: by_key(batches, settle)


def cut_rows(text_at: int, marks_at: int, length: int, schema: pa.Schema):
    """Cut the marked ranges out of each text; adds removed spans and the bytes that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_view(batch.column(text_at))
            marks = batch.column(marks_at)
            at = marks.offsets.to_numpy()
            flat = marks.flatten()
            shift = at[0]
            ms, mw = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            valid = marks.is_valid().to_numpy(zero_copy_only=False)
            spans, kept = [], []
            for i in range(len(batch)):
                own = data[offsets[i] : offsets[i + 1]]
                if not valid[i] or at[i + 1] == at[i]:
                    spans.append([])
                    kept.append(own.tobytes())
                    continue
                sl = slice(at[i] - shift, at[i + 1] - shift)
                start = np.sort(ms[sl] << 32 | mw[sl])
                end = np.minimum((start >> 32) + (start & 0xFFFFFFFF) + length, len(own))
                start = np.minimum(start >> 32, len(own))
                reach = np.maximum.accumulate(end)
                head = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
                a, b = start[head], reach[np.append(head[1:], len(start)) - 1]
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True) if y > x])
                left = zip(np.append(0, b), np.append(a, len(own)), strict=True)
                kept.append(b"".join(own[x:y].tobytes() for x, y in left))
            cols = [batch.column(x) for x in range(batch.num_columns) if x != marks_at]
            extra = [pa.array(spans, schema.field(-2).type), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([x.cast(t.type) if x.type != t.type else x for x, t in zip(cols + extra, schema, strict=True)], schema=schema)

    return run


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove_repeats(docs: DataFrame, length: int = 100, spans: str = "removed_spans", kept: str = "kept") -> DataFrame:
    """docs with two more columns: maximal removed byte spans and the UTF-8 bytes that stay."""
    if length < 64 + K:
        raise ValueError("length must be at least 96 bytes")
    spark = docs.sparkSession
    n = partitions(spark)
    key, digest, marks = fresh(docs, "doc_key"), fresh(docs, "digest"), fresh(docs, "marks")
    keyed = docs.withColumns({key: doc_key(docs), digest: F.xxhash64("text")})
    first = keyed.select(key, digest, "text").mapInArrow(anchor_rows(length, FLUSH), ROWS_SQL).repartition(n, "k").sortWithinPartitions("k")
    settled = materialise(first.mapInArrow(settle_anchors, MARKS_SQL), "anchors")
    edges = settled.where(F.col("f") == BY_CONTEXT).drop("f")
    # a hot 32-gram's rows are spread over as many keys as SPREAD before they meet the note that it is hot
    salt = F.pmod(F.xxhash64("doc", "d", "s"), F.lit(SPREAD)).cast("int").alias("salt")
    hot = edges.groupBy("h").count().where(F.col("count") > HOT).select("h", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"), F.lit(True).alias("hot"))
    row = [F.col("doc").alias(key), F.col("d").alias(digest)]
    ranges = edges.select("*", salt).join(hot, ["h", "salt"], "left").groupBy(*row).agg(F.collect_list(F.struct("s", "w", "h", F.coalesce("hot", F.lit(False)).alias("hot"))).alias(marks))
    wide = keyed.join(ranges.hint("shuffle_hash"), [key, digest])  # the exchange of the texts is the one of the join below
    at = [wide.columns.index(x) for x in (key, digest, "text", marks)]
    more = wide.mapInArrow(window_rows(*at, length), WINDOWS_SQL).repartition(n, "k").sortWithinPartitions("k").mapInArrow(settle_windows(length), MARKS_SQL)
    found = settled.where(F.col("f") == MARK).unionByName(more).groupBy(*row).agg(F.collect_list(F.struct("s", "w")).alias(marks))
    joined = keyed.join(found.hint("shuffle_hash"), [key, digest], "left").select(*docs.columns, marks)
    from pyspark.sql.pandas.types import to_arrow_schema

    out = T.StructType([*docs.schema.fields, T.StructField(spans, SPANS), T.StructField(kept, T.BinaryType())])
    return joined.mapInArrow(cut_rows(docs.columns.index("text"), len(docs.columns), length, to_arrow_schema(out)), out)


def op1_suffix_repeats(spark, sf_dir: str) -> DataFrame:
    """Bytes that a 100-byte string with an earlier start covers, removed from every document."""
    from .common import documents

    out = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    gone = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", (F.length("kept") + gone).cast("long").alias("n_bytes"), gone.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
