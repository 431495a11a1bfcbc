"""Best-fit packing of token sequences, planned on a histogram of lengths.

The plan sees counts of lengths, at most `room` of them, and never a document. It goes through lengths
from long to short; all pieces of one length go at once to the ranges of equal sequences that they fit
most tightly. A plan is a short list of segments: of the pieces of a length, ranks r to r + m go to
sequences s to s + m at one offset. Pieces then find their slots by their rank within their length. A
rank is that within a hash bucket of the length plus the buckets before, so no length is ever sorted in
one task. Ranks follow from all that a piece is, its digest included, so a lost task gives the same
slots again; only equal pieces of equal rows may change places.

Defined results. A null or empty text has the end token alone. Repeated rows are packed each. A document
longer than a sequence is cut so that its first piece is the shorter one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import BYTES, public_vocabulary, vocabulary
from .common import fresh, materialise, partitions, repeat_ranges, text_chunks, utf8_view

ROOM = 1024


def plan(counts: dict[int, int], room: int = ROOM) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts: segments (length, first rank, pieces, first sequence, offset)."""
    free: list[list[tuple[int, int]]] = [[] for _ in range(room + 1)]  # by room left: ranges (first sequence, sequences)
    out, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= room:
            raise ValueError(f"no piece may have {length} tokens")
        fit = length
        while left and fit <= room:
            if not free[fit]:
                fit += 1
                continue
            s, m = free[fit].pop()
            t = min(left, m)
            out.append((length, rank, t, s, room - fit))
            free[fit - length].append((s, t))
            if t < m:
                free[fit].append((s + t, m - t))
            left, rank, fit = left - t, rank + t, length  # what is left of a sequence may be the tightest fit now
        each = room // length
        for per, m in ((each, left // each), (left % each, 1)):
            if per and m and left:
                out += [(length, rank + i * m, m, opened, i * length) for i in range(per)]
                free[room - per * length].append((opened, m))
                opened, rank, left = opened + m, rank + per * m, left - per * m
    return out


def piece_rows(docs: DataFrame, path: str, end: int, room: int = ROOM) -> DataFrame:
    """A row (doc_id, piece, start, length, ids_crc32) for each piece of each text's ids and the end token."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            data, off = utf8_view(batch.column(1))
            for i, j in text_chunks(off, BYTES):
                ids, n, _ = words.encode_chunk(data, off[i : j + 1])
                whole = np.insert(ids, np.cumsum(n), end).astype("<u4")
                size = n + 1
                pieces = (size + room - 1) // room
                own = np.repeat(np.arange(j - i), pieces)
                piece = repeat_ranges(np.zeros(j - i, np.int64), pieces)
                head = (size - room * (pieces - 1))[own]
                start = np.where(piece > 0, head + (piece - 1) * room, 0)
                length = np.where(piece > 0, room, head)
                at = ((np.cumsum(size) - size)[own] + start) * 4
                raw = memoryview(whole).cast("B")
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist(), strict=True)]
                doc = batch.column(0).slice(i, j - i).take(pa.array(own))
                yield pa.RecordBatch.from_arrays([doc, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(pieces: DataFrame, room: int = ROOM) -> DataFrame:
    """pieces (with doc_id, piece and length, and any other columns) with sequence_id and offset."""
    spark = pieces.sparkSession
    bucket, ahead, rank = (fresh(pieces, x) for x in ("bucket", "ahead", "rank"))
    dealt = pieces.withColumn(bucket, F.pmod(F.xxhash64(*pieces.columns), F.lit(partitions(spark))))
    counts = materialise(dealt.groupBy("length", bucket).agg(F.count("*").alias(ahead)), "lengths")
    segments = plan({r[0]: r[1] for r in counts.groupBy("length").agg(F.sum(ahead)).collect()}, room)
    before = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", bucket, F.coalesce(F.sum(ahead).over(before), F.lit(0)).alias(ahead))
    within = Window.partitionBy("length", bucket).orderBy(*pieces.columns)
    ranked = dealt.withColumn(rank, F.row_number().over(within)).join(offsets, ["length", bucket]).select(*pieces.columns, (F.col(rank) + F.col(ahead) - 1).alias(rank))
    table = np.array(sorted(segments), np.int64).reshape(-1, 5)
    keys = table[:, 0] << 44 | table[:, 1]
    at = spark.sparkContext.broadcast((keys, table))  # as many segments as the plan has, whatever the documents
    col = pieces.columns.index("length")
    names = [*pieces.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = at.value
        for batch in batches:
            length, r = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (col, -1))
            s = np.searchsorted(keys, length << 44 | r, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(table[s, 3] + r - table[s, 1]), pa.array(table[s, 4])], names=names)

    from pyspark.sql import types as T

    return ranked.mapInArrow(run, T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack_documents(docs: DataFrame, path: str, end: int = 2, room: int = ROOM) -> DataFrame:
    return place(materialise(piece_rows(docs, path, end, room), "pieces"), room)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    from .common import documents

    return pack_documents(documents(spark, sf_dir), public_vocabulary("byte_bpe_50k.json"))
