"""Document fingerprints by Order MinHash, sensitive to edit distance.

K-mers are `k` code points long. A k-mer that occurs several times counts each time, numbered by
occurrence, so every (k-mer, number) is distinct. One hash of each deals it to one of `slots` parts and
orders the parts; a part keeps its `take` smallest, puts them back into text order and hashes the tuple
of their k-mers to one signature entry. Two texts agree in an entry when the same k-mers were selected
and stand in the same order, so moving text about lowers the likeness as replacing it does. A part with
fewer k-mers keeps what it has; an empty part says so by a fixed value.

Likeness is the share of agreeing entries among those that at least one text fills; two texts without
k-mers are alike. A text shorter than `k` is one k-mer, itself.

The edited text and the next document come from one pass over documents in descending doc_id: they are
dealt by quantiles of doc_id, and the first document of each part is sent to the part before as well.

Defined results. A null text is empty; an empty text has no k-mers. A null doc_id comes last. Repeated
rows follow each other; of rows with one doc_id the order is that of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, mix64, partitions

SLOTS, TAKE, K = 64, 2, 8
EMPTY = np.uint32(0)
NULL_ID = -(2**63)
M1, M2, M4, N = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def kmers(cp: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all k-mers of code points, in text order; k is a power of two."""
    h = mix64(cp.astype(np.uint64) + N)
    if len(h) < k:
        whole = np.zeros(1, np.uint64)
        for i in range(len(h)):
            whole = whole * M1 + h[i : i + 1]
        return mix64(whole) if len(h) else h
    size = 1
    for m in (M1, M2, M4, N, M1):
        if size == k:
            break
        h = h[:-size] * m + h[size:]
        size *= 2
    return mix64(h)


def signature(cp: np.ndarray, slots: int = SLOTS, take: int = TAKE, k: int = K) -> np.ndarray:
    """Entries of a text's fingerprint, EMPTY where no k-mer was dealt."""
    h = kmers(cp, k)
    out = np.zeros(slots, np.uint32)
    n = len(h)
    if not n:
        return out
    order = np.argsort(h, kind="stable")  # equal k-mers stand together, in text order
    s = h[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    at = np.arange(n)
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    u = mix64(s + number.astype(np.uint64) * M2)
    slot = (u >> np.uint64(58)).astype(np.int64) if slots == 64 else (u % np.uint64(slots)).astype(np.int64)
    if n > 64 * slots:  # only small hashes can be selected; parts left short by that are taken from all
        few = np.flatnonzero((u << np.uint64(6)) < np.uint64(int(2**64 * min(1.0, 24 * slots * take / n / take))))
        if np.bincount(slot[few], minlength=slots).min() >= take:
            u, slot, order, s = u[few], slot[few], order[few], s[few]
    rank = np.lexsort((u, slot))
    slot = slot[rank]
    head = np.searchsorted(slot, np.arange(slots))
    size = np.minimum(np.diff(np.append(head, len(slot))), take)
    full = np.flatnonzero(size)
    pick = rank[np.minimum(head[full][:, None] + np.arange(take), len(slot) - 1)]
    there = np.arange(take) < size[full][:, None]
    place = np.where(there, order[pick], n + 1)
    back = np.argsort(place, axis=1, kind="stable")
    tuples = np.take_along_axis(np.where(there, s[pick], np.uint64(1)), back, 1)
    entry = np.zeros(len(full), np.uint64)
    for t in range(take):
        entry = entry * M4 + tuples[:, t]
    out[full] = (mix64(entry + size[full].astype(np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    filled = (a != EMPTY) | (b != EMPTY)
    total = int(filled.sum())
    return float(((a == b) & filled).sum() / total) if total else 1.0


def points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def edited(own: str, after: str) -> str:
    """The last third (rounded down) of the code points replaced by as many of the next text, or all it has."""
    cut = len(own) // 3
    return own[: len(own) - cut] + after[:cut] if cut else own


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
SCHEMA_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, doc_id, key, text, guest) sorted by part, then as documents follow; a part ends with a guest, the first of the next."""
    held = None  # part, doc_id, text, signature
    for batch in batches:
        part, guest = batch.column(0).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
        ids = batch.column(1).to_pylist()
        out: list[tuple] = []
        for i in range(len(batch)):
            if guest[i] and (held is None or held[0] != part[i]):
                continue  # more guests of one doc_id, or a part without documents of its own
            text = batch.column(3)[i].as_py() or ""
            sig = held[3] if held is not None and held[2] == text else signature(points(text))
            if held is not None and held[0] == part[i]:
                out.append(_row(held, text, sig))
            held = None if guest[i] else (part[i], ids[i], text, sig)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t.type) for x, t in zip(zip(*out, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def _row(held: tuple, after: str, after_sig: np.ndarray) -> tuple:
    _, doc, text, sig = held
    new = edited(text, after)
    new_sig = sig if new == text else signature(points(new))
    return doc, len(text), hashlib.sha256(new.encode()).hexdigest(), sig.astype(">u4").tobytes().hex(), new_sig.astype(">u4").tobytes().hex(), likeness(sig, new_sig), likeness(sig, after_sig)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likenesses to it and to the next document."""
    spark = docs.sparkSession
    parts = max(1, 2 * partitions(spark))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    keyed = docs.select(key.alias("key"), "doc_id", "text")
    cuts = keyed.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else None
    cuts = sorted(set(cuts or []))
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:  # part 0 holds the greatest
        return pd.Series(len(bounds) - np.searchsorted(bounds, keys.to_numpy(), side="right"))

    keyed = keyed.withColumn("part", part_of("key"))
    firsts = [(r.part, r.key) for r in keyed.select("key", "part").groupBy("part").agg(F.max("key").alias("key")).orderBy("part").collect()]  # as many as parts
    if not firsts:
        return spark.createDataFrame([], SCHEMA_SQL)
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}  # the first document of all follows the last

    @F.pandas_udf("int")
    def also(keys: pd.Series) -> pd.Series:
        return keys.map(before).astype("Int32")

    homes = F.filter(F.array(F.struct(F.col("part").alias("p"), F.lit(False).alias("guest")), F.struct(F.col("also").alias("p"), F.lit(True).alias("guest"))), lambda x: x["p"].isNotNull())
    dealt = keyed.withColumn("also", also("key")).select(F.explode(homes).alias("home"), "doc_id", "key", "text").select("home.p", "doc_id", "key", "text", "home.guest")
    return dealt.repartition(parts, "p").sortWithinPartitions("p", "guest", F.desc("key"), "text").mapInArrow(fingerprint_rows, SCHEMA_SQL)


def op3_order_minhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    from .common import documents

    return fingerprints(documents(spark, sf_dir))
