"""Word shingles of whole texts as 64-bit hashes, computed on bytes.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D; A-Z count as a-z. UTF-8 keeps those
bytes for these characters alone, so bytes give the same words as characters.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

from .common import CHUNK, byte_table, mix64, repeat_ranges

ODD = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xC2B2AE3D27D4EB4F)]
BASE = 0x5851F42D4C957F2D
SHORT = np.uint64(0x2545F4914F6CDD1D)
#: Bytes of the longest word with a polynomial hash.
LONG = 64
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Hash word and space flag by byte."""
    low = np.arange(256)
    low[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return byte_table(11)[low], space


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, np.uint64(BASE))
    down = np.full(n, np.uint64(pow(BASE, -1, 2**64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts data[offsets[i]:offsets[i + 1]] in order, and how many each text has.

    A word of up to LONG bytes has a polynomial hash, computed in steps of about CHUNK bytes whatever
    the length of a text. Such a hash modulo 2 ** 64 fails on longer words of regular build, so those
    have a cryptographic one.
    """
    table, space = _tables()
    base = int(offsets[0])
    own = data[base : int(offsets[-1])]
    n = len(own)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    inside = np.zeros(n + 2, bool)
    np.logical_not(space[own], out=inside[1:-1])
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1] - base
    mid = cuts[(cuts > 0) & (cuts < n)]  # a word never runs from one text into the next
    starts[mid] = inside[1:-1][mid]
    ends[mid - 1] = inside[1:-1][mid - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    del inside, starts, ends
    h = np.zeros(len(s), np.uint64)
    up, down = _powers(CHUNK + LONG)
    short = np.flatnonzero(e - s <= LONG)
    step = s[short] // CHUNK
    cut = np.flatnonzero(np.concatenate([[True], step[1:] != step[:-1], [True]])) if len(short) else short
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        at = short[i:j]
        a, b = int(s[at[0]]), int(e[at[-1]])
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[own[a:b]] * up[: b - a], out=total[1:])
        h[at] = mix64((total[e[at] - a] - total[s[at] - a]) * down[s[at] - a])
    for i in np.flatnonzero(e - s > LONG):
        h[i] = long_hash(own[s[i] : e[i]].tobytes().translate(_FOLD))
    return h, np.diff(np.searchsorted(s, offsets - base))


def long_hash(x: bytes) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little"))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All k-word shingles of each text (with repeats) and their number; a text of fewer words has one, of all its words."""
    w, counts = words(data, offsets)
    first = np.cumsum(counts) - counts
    number = np.maximum(counts - k + 1, 0)
    at = repeat_ranges(first, number)
    h = np.zeros(len(at), np.uint64)
    for t in range(k):
        h += w[at + t] * ODD[t]
    h = mix64(h)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for t in range(k - 1):
            there = counts[short] > t
            extra[there] += w[first[short][there] + t] * ODD[t]
        extra = mix64(extra + counts[short].astype(np.uint64) * SHORT)
        number = number.copy()
        number[short] = 1
        h = np.insert(h, (np.cumsum(number) - number)[short] - np.arange(len(short)), extra)
    return h, number


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and their number."""
    h, number = shingle_hashes(data, offsets, k)
    if not len(h):
        return h, number
    own = np.repeat(np.arange(len(number)), number)
    ends = np.cumsum(number)
    for a, b in zip(ends - number, ends, strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[new], np.bincount(own[new], minlength=len(number))
