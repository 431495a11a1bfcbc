"""Byte-level BPE: encoding and decoding of whole texts, a batch at a time.

Pre-tokenisation runs no regular expression. Each code point becomes a class (letter, number, white
space, other). A code point's class acts on the scanning state as a transition function: it either
keeps the open run or starts one at its own place, so each function is the identity or a constant,
their composition is associative, and one maximum scan composes all of them and gives every place the
start of its run. What the pattern adds to runs - a blank that goes with the run after it, white space
that gives up its last character, contractions - depends on a run's ends alone.

A long text goes in parts of bounded size, cut where a slice begins whatever stands around: where the
class changes, but for white space and what follows an apostrophe, and before a single blank. Only one
run of letters, of digits or of blanks is never cut: the pattern makes one slice of it.

Slices between boundaries keep their byte offsets. Distinct slices are merged once: those that a
bounded cache lacks go through pair merging together, as matrices of token ids; merges of one step
happen in all rows at once.

Defined results. A null or empty text has no tokens. Special tokens' strings are ordinary text.
Bytes that are no UTF-8 can't occur in a string column; decoding returns the very bytes encoded.
"""

from __future__ import annotations

import base64
import functools
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_table, mix64, repeat_ranges, text_chunks, utf8_view
from .shingles import LONG, long_hash

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The code points with the White_Space property.
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BYTES = 800_000
CACHED = 150_000
WIDE = 48
NONE = np.int32(2**31 - 1)
BASE = 0x369DEA0F31A53F85


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point, from its Unicode general category."""
    out = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    out[:] = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = SPACE
    return out


def boundaries(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in code points of texts that start at `first` (ascending, each before the end)."""
    n = len(cp)
    cls = classes()[cp]
    new = np.ones(n + 1, bool)
    new[1:n] = cls[1:] != cls[:-1]
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    edge[n] = True
    new |= edge
    run = np.maximum.accumulate(np.where(new[:n], np.arange(n, dtype=np.int32), 0))  # the scan: the start of each place's run
    start = new.copy()
    heads = np.flatnonzero(new[:n])
    heads = heads[~edge[heads]]
    after_space = heads[cls[heads - 1] == SPACE]  # a run of non-space that white space of the same text precedes
    start[after_space - 1] = True
    start[after_space[cp[after_space - 1] == 32]] = False
    quote = np.flatnonzero(cp == 39)
    quote = quote[(quote + 1 < n)]
    quote = quote[(run[quote] == quote) & new[quote + 1] & ~edge[quote + 1] & start[quote]]
    if len(quote):
        tail = np.concatenate([cp, np.zeros(3, cp.dtype)])
        a, b = tail[quote + 1], tail[quote + 2]
        same = ~np.concatenate([edge, [True, True]])[quote + 2]
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = same & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        hit = one | two
        quote, size = quote[hit], np.where(one[hit], 1, 2)
        start[quote + 1] = False
        start[np.minimum(quote + 1 + size, n)] = True
    return np.flatnonzero(start[:n])


def sure_starts(cp: np.ndarray) -> np.ndarray:
    """Places within a stretch of a text at which a slice begins whatever stands before and after the stretch."""
    cls = classes()[cp]
    a, b = cls[:-1], cls[1:]
    sure = np.zeros(len(cp), bool)
    sure[1:] = (a != b) & (a != SPACE) & (b != SPACE) & ((a != OTHER) | (b != LETTER) | (cp[:-1] != 39))
    sure[1:-1] |= (cp[1:-1] == 32) & (cls[:-2] != SPACE) & (cls[2:] != SPACE)
    return np.flatnonzero(sure)


def cut_points(data: np.ndarray, offsets: np.ndarray, most: int, look: int = 4096) -> np.ndarray:
    """offsets with more places at which a slice begins, so that parts have about `most` bytes; a longer run stays whole."""
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        at, width = a, look
        out.append(a)
        while b - at > most:
            end = min(at + most - look + width, b)
            lo = max(end - width, at)
            near = data[lo:end]
            lead = np.flatnonzero((near & 0xC0) != 0x80)
            lead = lead[:-1] if end < b else lead  # the last code point may be cut
            text = near[lead[0] : lead[-1]].tobytes().decode("utf-8") if len(lead) > 1 else ""
            found = sure_starts(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int32)) if text else lead[:0]
            if len(found) and lo + int(lead[found[-1]]) > at:
                at, width = lo + int(lead[found[-1]]), look
                out.append(at)
            elif end == b:
                break
            else:
                width = 2 * width
    return np.array([*out, offsets[-1]], np.int64)


class Vocabulary:
    """Tokens and merges of one file."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                model = json.load(f)["model"]
            back = {c: b for b, c in enumerate(_visible())}
            raw = {bytes(back[c] for c in k): v for k, v in model["vocab"].items() if all(c in back for c in k)}
            pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
            ids = model["vocab"]
            keys = [(ids[a] << 32 | ids[b], i, ids[a + b]) for i, (a, b) in enumerate(pairs)]
            self.whole: dict[bytes, int] = {}
        else:
            with open(path, "rb") as f:
                raw = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            keys = [(raw[t[:i]] << 32 | raw[t[i:]], r, r) for t, r in raw.items() for i in range(1, len(t)) if t[:i] in raw and t[i:] in raw]
            self.whole = raw
        keys.sort()
        self.keys = np.array([k[0] for k in keys], np.int64)
        self.ranks = np.array([k[1] for k in keys], np.int32)
        self.merged = np.zeros(max(int(self.ranks.max(initial=0)) + 1, 1), np.int32)
        self.merged[self.ranks] = [k[2] for k in keys]
        self.lookup = {k[0]: k[1] for k in keys}
        self.bytes = np.array([raw[bytes([b])] for b in range(256)], np.int32)
        self.two = self.pair_ranks(np.repeat(self.bytes, 256), np.tile(self.bytes, 256)).reshape(256, 256)
        size = max(raw.values()) + 1
        tokens = [b""] * size
        for t, i in raw.items():
            tokens[i] = t
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.cache: dict[int, bytes] = {}

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """One piece by a heap of pairs over a linked list."""
        ids = [int(self.bytes[b]) for b in piece]
        n = len(ids)
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        get = lambda i: self.lookup.get(ids[i] << 32 | ids[right[i]]) if right[i] < n else None
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.lookup.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            r, i, a, b = heappop(heap)
            if not alive[i] or ids[i] != a or right[i] >= n or ids[right[i]] != b:
                continue
            j = right[i]
            ids[i], alive[j], right[i] = int(self.merged[r]), False, right[j]
            if right[i] < n:
                left[right[i]] = i
            for k in (left[i], i):
                if k >= 0 and (x := get(k)) is not None:
                    heappush(heap, (x, k, ids[k], ids[right[k]]))
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], np.uint32)

    def merge_many(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Token ids (packed) of many short pieces at once."""
        out: list[bytes] = [b""] * len(starts)
        order = np.argsort(lengths, kind="stable")
        cut = np.searchsorted(lengths[order], [4, 8, 12, 16, 24, 32, WIDE], side="right")
        for a, b in zip([0, *cut[:-1]], cut, strict=True):
            for c in range(a, b, 20_000):
                rows = order[c : min(c + 20_000, b)]
                if len(rows):
                    ids, count = self._merge_matrix(data, starts[rows], lengths[rows])
                    packed = ids[np.arange(ids.shape[1]) < count[:, None]].astype("<u4").tobytes()
                    ends = np.cumsum(count) * 4
                    for r, e, k in zip(rows.tolist(), ends.tolist(), (count * 4).tolist(), strict=True):
                        out[r] = packed[e - k : e]
        return out

    def _merge_matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = int(lengths.max())
        col = np.arange(width)
        raw = data[np.minimum(starts[:, None] + col, len(data) - 1)]
        ids = self.bytes[raw]
        rank = np.full((len(starts), width), NONE, np.int32)
        rank[:, :-1] = self.two[raw[:, :-1], raw[:, 1:]]
        rank[col[None, :] >= (lengths - 1)[:, None]] = NONE
        count = lengths.copy()
        live = np.arange(len(starts))
        while len(live):
            sub = rank[live]
            j = sub.argmin(1)
            best = sub[np.arange(len(live)), j]
            go = best != NONE
            live, j, best, sub = live[go], j[go], best[go], sub[go]
            if not len(live):
                break
            source = np.minimum(col + (col >= j[:, None]), width - 1)
            sub = np.take_along_axis(sub, source, 1)
            sub[:, -1] = NONE
            own = ids[live]
            own[np.arange(len(live)), j] = self.merged[best]
            own = np.take_along_axis(own, np.minimum(col + (col > j[:, None]), width - 1), 1)
            count[live] -= 1
            at = np.arange(len(live))
            for k in (j - 1, j):
                ok = (k >= 0) & (k + 1 < count[live])
                sub[at[ok], k[ok]] = self.pair_ranks(own[at[ok], k[ok]], own[at[ok], k[ok] + 1])
            gone = (j >= 0) & (j + 1 >= count[live])
            sub[at[gone], j[gone]] = NONE
            rank[live], ids[live] = sub, own
        return ids, count

    def encode_chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of all texts, how many each text has, and the byte offset in its text at which each token's slice starts."""
        base = int(offsets[0])
        own = np.ascontiguousarray(data[base : int(offsets[-1])])
        m = len(offsets) - 1
        if len(own) > 4 * BYTES:
            cuts = cut_points(own, offsets - base, BYTES)
            found = [self.encode_chunk(own, cuts[i : i + 2]) if cuts[i + 1] - cuts[i] <= 4 * BYTES else self._encode(own[cuts[i] : cuts[i + 1]], np.array([0, cuts[i + 1] - cuts[i]])) for i in range(len(cuts) - 1)]
            parts = np.concatenate([[0], np.cumsum([len(x[0]) for x in found])])
            whose = (offsets[:-1] - base)[np.searchsorted(offsets - base, cuts[:-1], side="right") - 1]
            where = np.concatenate([x[2] + c - w for x, c, w in zip(found, cuts[:-1], whose, strict=True)])
            return np.concatenate([x[0] for x in found]), np.diff(parts[np.searchsorted(cuts, offsets - base)]), where
        return self._encode(own, offsets - base)

    def _encode(self, own: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base, m = 0, len(offsets) - 1
        if not len(own):
            return np.zeros(0, np.uint32), np.zeros(m, np.int64), np.zeros(0, np.int64)
        lead = np.flatnonzero((own & 0xC0) != 0x80)
        cp = np.frombuffer(own.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int32)
        text_at = offsets[:-1] - base
        first = np.searchsorted(lead, text_at[text_at < offsets[1:] - base])
        starts = lead[boundaries(cp, first)]
        ends = np.append(starts[1:], len(own))
        up, down = _powers(1 << max(16, int(len(own) + 1).bit_length()))
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(byte_table(23)[own] * up[: len(own)], out=total[1:])
        keys = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts > LONG):  # a polynomial modulo 2 ** 64 fails on long slices of regular build
            keys[i] = long_hash(own[starts[i] : ends[i]].tobytes())
        codes, distinct = pd.factorize(keys)
        at = np.empty(len(distinct), np.int64)
        at[codes[::-1]] = np.arange(len(codes))[::-1]
        found = list(map(self.cache.get, distinct.tolist()))
        miss = np.array([i for i, x in enumerate(found) if x is None], np.int64)
        if len(miss):
            s, size = starts[at[miss]], ends[at[miss]] - starts[at[miss]]
            raw = own.tobytes()
            made: list[bytes | None] = [None] * len(miss)
            if self.whole:
                for i, (x, k) in enumerate(zip(s.tolist(), size.tolist(), strict=True)):
                    token = self.whole.get(raw[x : x + k])
                    if token is not None:
                        made[i] = token.to_bytes(4, "little")
            for i in np.flatnonzero(size > WIDE).tolist():
                if made[i] is None:
                    made[i] = self.merge_long(raw[s[i] : s[i] + size[i]]).astype("<u4").tobytes()
            todo = np.array([i for i, x in enumerate(made) if x is None], np.int64)
            if len(todo):
                for i, x in zip(todo.tolist(), self.merge_many(own, s[todo], size[todo]), strict=True):
                    made[i] = x
            if len(self.cache) + len(miss) > CACHED:
                self.cache.clear()
            short = size <= WIDE
            for i, key, x, keep in zip(miss.tolist(), distinct[miss].tolist(), made, short.tolist(), strict=True):
                found[i] = x
                if keep:
                    self.cache[key] = x
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter((len(x) for x in found), np.int64, len(found)) >> 2
        begin = np.cumsum(size) - size
        per = size[codes]
        ids = flat[repeat_ranges(begin[codes], per)]
        tokens = np.concatenate([[0], np.cumsum(per)])
        which = np.searchsorted(starts, offsets - base)
        text_of = np.searchsorted(text_at, starts, side="right") - 1
        return ids, np.diff(tokens[which]), np.repeat(starts - text_at[text_of], per)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            raise ValueError("an id is not in the vocabulary")
        return self.flat[repeat_ranges(self.starts[ids], self.lengths[ids])]


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, np.uint64(BASE)), np.full(n, np.uint64(pow(BASE, -1, 2**64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _visible() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(flat: np.ndarray, counts: np.ndarray, width: int) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]) * width
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def encode(docs: DataFrame, path: str, ids: str = "ids", offsets: str | None = None) -> DataFrame:
    """docs with `ids`, each text's token ids as packed little-endian 32-bit integers; with `offsets`, the byte at which each token's slice starts, packed as 64-bit integers. Columns that had these names are replaced."""
    docs = docs.drop(*(x for x in (ids, offsets) if x))
    at, names = docs.columns.index("text"), [*docs.columns, ids, *([offsets] if offsets else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            data, off = utf8_view(batch.column(at))
            for i, j in text_chunks(off, BYTES):
                x, n, where = words.encode_chunk(data, off[i : j + 1])
                cols = [c.slice(i, j - i) for c in batch.columns] + [_packed(x.astype("<u4"), n, 4)]
                if offsets:
                    cols.append(_packed(where.astype("<i8"), n, 8))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    more = [T.StructField(x, T.BinaryType()) for x in (ids, offsets) if x]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the bytes that its packed ids stand for; a column that had the name is replaced."""
    df = df.drop(out)
    at, names = df.columns.index(ids), [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            col = batch.column(at).cast(pa.large_binary())
            off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1 + col.offset)[col.offset :] if len(col) else np.zeros(1, np.int64)
            data = np.frombuffer(col.buffers()[2] or b"", np.uint8) if len(col) else np.zeros(0, np.uint8)
            for i, j in text_chunks(off, 4 * BYTES):
                own = np.frombuffer(data[off[i] : off[j]].tobytes(), "<u4")
                raw = words.decode(own)
                size = np.concatenate([[0], np.cumsum(words.lengths[own.astype(np.int64)])])
                n = np.diff(size[(off[i : j + 1] - off[i]) >> 2])
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), _packed(raw, n, 1)], names=names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Whole texts to ids of the multilingual vocabulary and back."""
    from .common import documents

    path = public_vocabulary("byte_bpe_multi_50k.tiktoken")
    ids = encode(documents(spark, sf_dir).select("doc_id", "text"), path).drop("text")
    return decode(ids, path).select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
