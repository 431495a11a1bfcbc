"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

Each text gives a fixed vector of statistics. Standardised and clipped, they go through random Fourier
features, whose inner products approximate a Gaussian kernel. Ridge regression on them needs only the
normal equations, which every task sums over its labelled rows; the sums are added in two steps. All
labelled rows count; there is no sample. Labelled rows fall into two halves by a hash: each half is
scored by weights from the other, and the pool-adjacent-violators fit of those scores (summed into
BINS bins) turns ridge scores into probabilities. The weights in use come from both halves.

Defined results. A null text is empty and is scored from its statistics like any other. Labels without a
quality or without a document are left out; several labels of a document count each. Without labels, or
with one class alone, every score is the share of quality 1 (0.5 without labels).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, fresh, materialise, partitions, release, ship, text_chunks, utf8_view
from .shingles import words

FEATURES, WIDTH, RIDGE, BINS, SEED = 256, 6.0, 1e-3, 1000, 17
THRESHOLD = 0.3
#: Byte classes whose shares count.
GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".,;:", b"!?", b"|", b"#%$&*@^~+=<>\\_", b"()[]{}/\"'`-", b"aeiouAEIOU", bytes(range(128, 256))]
STATS = len(GROUPS) + 10


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATS numbers for each text."""
    n = len(offsets) - 1
    base = int(offsets[0])
    own = data[base : int(offsets[-1])]
    size = np.diff(offsets)
    out = np.zeros((n, STATS))
    some = np.flatnonzero(size)
    if not len(some):
        return out
    starts = (offsets[:-1] - base)[some]
    length = size[some].astype(float)
    sums = lambda flags: np.add.reduceat(flags.astype(np.int32), starts)
    for k, group in enumerate(GROUPS):
        table = np.zeros(256, np.int32)
        table[list(group)] = 1
        out[some, k] = np.add.reduceat(table[own], starts) / length
    k = len(GROUPS)
    out[some, k] = np.log1p(length)
    h, count = words(data, offsets)
    number = np.maximum(count[some], 1)
    out[some, k + 1] = np.log1p(count[some])
    out[some, k + 2] = length / number
    same = np.zeros(len(own), bool)
    same[1:] = own[1:] == own[:-1]
    same[starts] = False
    out[some, k + 3] = sums(same) / length
    ascii_mark = np.zeros(256, bool)
    ascii_mark[list(b"#%$&*@^~+=<>\\_!?|")] = True
    mark = ascii_mark[own]
    twice = np.zeros(len(own), bool)
    twice[1:] = mark[1:] & mark[:-1]
    twice[starts] = False
    out[some, k + 4] = sums(twice) / length
    first = np.cumsum(count) - count
    lines = np.flatnonzero(own == 10)
    for row, i in enumerate(some.tolist()):
        w = h[first[i] : first[i] + count[i]]
        if len(w):
            w = np.sort(w)
            new = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1], [True]]))
            out[i, k + 5] = (len(new) - 1) / len(w)
            out[i, k + 6] = np.diff(new).max() / len(w)
        a, b = np.searchsorted(lines, (offsets[i] - base, offsets[i + 1] - base))
        out[i, k + 7] = np.log1p(b - a)
        out[i, k + 8] = math.log1p(length[row] / (b - a + 1))
    out[some, k + 9] = out[some, 1] / (out[some, 0] + out[some, 1] + 1e-9)
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    levels: np.ndarray = field(default_factory=lambda: np.array([0.5]))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel of width WIDTH, and a constant."""
    rnd = np.random.default_rng(SEED)
    w = rnd.standard_normal((STATS, FEATURES)) / WIDTH
    b = rnd.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / scale, -5, 5)
    return np.concatenate([np.cos(x @ w + b) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))], 1)


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, STATS))


def _added(df: DataFrame, make) -> np.ndarray | None:
    """The sum of the arrays that make(batch) gives: within tasks, then within about sqrt(tasks) tasks, then here."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                x = make(batch)
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["x"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0).to_pylist():
                x = np.frombuffer(x)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["x"])

    few = max(1, math.isqrt(partitions(df.sparkSession)))
    rows = df.mapInArrow(within, "x binary").repartition(few).mapInArrow(again, "x binary").collect()
    parts = sorted(bytes(r.x) for r in rows)
    return sum(np.frombuffer(x) for x in parts) if parts else None


def pool_adjacent(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted isotonic (ascending) fit of y."""
    level: list[list[float]] = []
    for v, c in zip(y, w, strict=True):
        level.append([v, c, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v2, c2, n2 = level.pop()
            v1, c1, n1 = level.pop()
            level.append([(v1 * c1 + v2 * c2) / (c1 + c2), c1 + c2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in level]) if level else np.zeros(0)


def with_stats(docs: DataFrame, stats: str = "stats") -> DataFrame:
    """docs with the statistics of each text."""
    at, names = docs.columns.index("text"), [*docs.columns, stats]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_view(batch.column(at))
            for i, j in text_chunks(offsets):
                x = statistics(data, offsets[i : j + 1])
                own = pa.ListArray.from_arrays(np.arange(0, x.size + 1, STATS, dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), own], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(stats, T.ArrayType(T.DoubleType()))]))


def stats_of(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of each document."""
    return with_stats(docs.select(F.col("doc_id").cast("long"), "text")).drop("text")


def fit(stats: DataFrame, labels: DataFrame, column: str = "quality") -> Model:
    """stats (doc_id, stats) and labels (doc_id, quality 0/1) -> model."""
    named = labels.select(F.col("doc_id").cast("long"), F.col(column).cast("double").alias("y")).where("y is not null and doc_id is not null")
    rows = stats.groupBy("doc_id").agg(F.min("stats").alias("stats")).join(named, "doc_id").select("stats", "y", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("double").alias("half"))
    rows = materialise(rows, "labelled")

    def moments(batch):
        x = _matrix(batch.column(0))
        return np.concatenate([[len(x), batch.column(1).to_numpy().sum()], x.sum(0), (x * x).sum(0)])

    m = _added(rows, moments)
    model = Model(np.zeros(STATS), np.ones(STATS), np.zeros(FEATURES + 1))
    if m is None or m[1] in (0, m[0]):
        model.levels = np.array([0.5 if m is None else m[1] / m[0]])
        release(rows)
        return model
    n = m[0]
    mean = m[2 : 2 + STATS] / n
    scale = np.sqrt(np.maximum(m[2 + STATS :] / n - mean**2, 0))
    scale[scale < 1e-9] = 1.0
    d = FEATURES + 1

    def equations(batch):
        z = fourier(_matrix(batch.column(0)), mean, scale)
        y, half = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        out = np.zeros((2, d, d + 1))
        for k in (0, 1):
            own = z[half == k]
            out[k] = np.concatenate([own.T @ own, (own.T @ y[half == k])[:, None]], 1)
        return out.ravel()

    eq = _added(rows, equations).reshape(2, d, d + 1)
    solve = lambda a: np.linalg.solve(a[:, :d] + RIDGE * (n + 100) * np.eye(d), a[:, d])
    halves = [solve(eq[1]), solve(eq[0])]
    low, high = -0.5, 1.5

    def bins(batch):
        z = fourier(_matrix(batch.column(0)), mean, scale)
        y, half = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(int)
        s = np.where(half == 0, z @ halves[0], z @ halves[1])
        at = np.clip(((s - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)]).astype(float)

    b = _added(rows, bins).reshape(2, BINS)
    used = b[0] > 0
    centre = low + (np.flatnonzero(used) + 0.5) * (high - low) / BINS
    level = pool_adjacent(b[1][used] / b[0][used], b[0][used])
    release(rows)
    return Model(mean, scale, solve(eq[0] + eq[1]), centre, level)


def held_out(doc_id, folds: int = 5, fold: int = 0):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def score_stats(rows: DataFrame, model: Model, stats: str = "stats", score: str = "score") -> DataFrame:
    """rows with a score in place of the statistics."""
    at = rows.columns.index(stats)
    others = [f for f in rows.schema.fields if f.name != stats]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*left, pa.array(model.score(_matrix(batch.column(at))))], names=[*(f.name for f in others), score])

    return rows.mapInArrow(run, T.StructType([*others, T.StructField(score, T.DoubleType())]))


def training_labels(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.where(~held_out(F.col("doc_id")))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from labels outside the held-out fold."""
    stats = materialise(stats_of(documents(spark, sf_dir)), "stats")
    model = fit(stats, training_labels(spark, sf_dir))
    out = score_stats(stats, model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts."""
    ship(docs.sparkSession)
    stats, score = fresh(docs, "stats"), fresh(docs, "quality_score")
    held = materialise(with_stats(docs, stats), "scored")  # statistics stay with their rows: computed once, joined to nothing
    model = fit(held.select("doc_id", F.col(stats).alias("stats")), labels)
    return score_stats(held, model, stats, score).where(F.col(score) >= THRESHOLD).drop(score)
