"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become lower-cased letters with blanks between words; their 1-, 2- and 3-grams are hashed to
2**BITS features. Document frequencies come from all training documents. Weights are trained with
follow-the-regularised-leader (proximal, per-coordinate rates, elastic net) on a bounded sample: of
each language the SAMPLE documents with the smallest hash of doc_id and text, TOTAL in all; equal rows
count once there. A fifth of them is kept from training to fit the temperature that divides all logits.

Defined results. A text that is null or has no letter is `und` with score 0. Rows without lang are not
learnt from. Without any training row every text is `und`. Repeated rows get the same prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import LETTER, classes
from .common import documents, mix64

BITS, SAMPLE, TOTAL, EPOCHS = 14, 500, 20_000, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Features of a text and their counts; None without a letter."""
    if not text:
        return None
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = classes()[np.minimum(cp, 0x10FFFF)] == LETTER
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    cp = np.where(letter, cp, 32)[keep]
    if not letter.any():
        return None
    x = np.concatenate([[32], cp, [32]]).astype(np.uint64)
    h1 = x * M[0]
    h2 = h1[:-1] + x[1:] * M[1]
    h3 = h2[:-1] + x[2:] * M[2]
    at = np.concatenate([mix64(h1 + np.uint64(1)), mix64(h2 + np.uint64(2)), mix64(h3 + np.uint64(3))]) >> np.uint64(64 - BITS)
    count = np.bincount(at.astype(np.int64), minlength=1 << BITS)
    found = np.flatnonzero(count)
    return found, count[found]


def weigh(found: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear TF times IDF, of length one."""
    v = (1 + np.log(count)) * idf[found]
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """How many of all training texts have each feature, and how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros((1 << BITS) + 1, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                g = grams(t.as_py())
                if g:
                    df[g[0]] += 1
                    n += 1
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["f", "n"])

    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in training.select("text").mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.f] = r.n
    return out[:-1], int(out[-1])


def sample(training: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, features, counts) of the sampled documents, in a fixed order."""
    hashed = training.select("doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    # a language's count says how small a hash must be; only some more than SAMPLE rows go on to be ranked
    share = hashed.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(SAMPLE + 8 * math.sqrt(SAMPLE)) / F.count("*")).alias("share"))
    few = hashed.join(share, "lang").where(F.col("h").cast("double") / 2.0**64 + 0.5 <= F.col("share")).dropDuplicates(["lang", "doc_id", "h"])
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    few = few.withColumn("r", F.row_number().over(order)).where(F.col("r") <= SAMPLE).orderBy("r", "h", "doc_id", "lang").limit(TOTAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, lang, g[0].astype("<u4").tobytes(), g[1].astype("<u4").tobytes()) for h, lang, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) if (g := grams(t))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)], names=["h", "lang", "f", "n"])

    rows = few.select("h", "lang", "text").mapInArrow(run, "h long, lang string, f binary, n binary").collect()
    rows.sort(key=lambda r: (r.h, r.lang, bytes(r.f)))
    return [(r.lang, np.frombuffer(r.f, "<u4").astype(np.int64), np.frombuffer(r.n, "<u4").astype(np.float64)) for r in rows]


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """Languages, weights (features and a constant by language) and the temperature."""
    langs = sorted({r[0] for r in rows})
    index = {k: i for i, k in enumerate(langs)}
    vectors = [(index[lang], np.append(f, 1 << BITS), np.append(weigh(f, c, idf), 1.0)) for lang, f, c in rows]
    kept = [v for i, v in enumerate(vectors) if i % 5 == 0] if len(vectors) >= 20 else vectors
    learnt = [v for i, v in enumerate(vectors) if i % 5 or len(vectors) < 20]
    shape = ((1 << BITS) + 1, len(langs))
    z, n = np.zeros(shape), np.zeros(shape)

    def weights(f=slice(None)):
        zf, nf = z[f], n[f]
        return np.where(np.abs(zf) <= L1, 0.0, -(zf - np.sign(zf) * L1) / ((BETA + np.sqrt(nf)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for y, f, v in learnt:
            w = weights(f)
            logit = v @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y] -= 1.0
            g = v[:, None] * p[None, :]
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / ALPHA
            z[f] += g - sigma * w
            n[f] += g * g
    w = weights()
    logits = np.array([v @ w[f] for _, f, v in kept])
    ys = np.array([y for y, _, _ in kept])

    def loss(t):
        x = logits / t
        return float((np.log(np.exp(x - x.max(1, keepdims=True)).sum(1)) + x.max(1) - x[np.arange(len(ys)), ys]).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 93))
    return langs, w, float(min(grid, key=loss)) if len(langs) > 1 else 1.0


def predict(docs: DataFrame, langs: list[str], w: np.ndarray, temperature: float, idf: np.ndarray) -> DataFrame:
    """doc_id, lang_pred and score of each document."""
    model = docs.sparkSession.sparkContext.broadcast((w.astype(np.float32), idf))  # 2**BITS rows by the languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, idf = model.value
        for batch in batches:
            pred, score = [], []
            for t in batch.column(1):
                g = grams(t.as_py()) if langs else None
                if g is None:
                    pred.append("und")
                    score.append(0.0)
                    continue
                x = (weigh(*g, idf) @ w[g[0]] + w[-1]).astype(np.float64) / temperature
                p = np.exp(x - x.max())
                p /= p.sum()
                k = int(p.argmax())
                pred.append(langs[k])
                score.append(float(p[k]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Learn from training (doc_id, text, lang) and predict docs."""
    training = training.where("lang is not null and text is not null").select(F.col("doc_id").cast("long"), "text", "lang")
    df, n = document_frequencies(training)
    idf = np.log((1 + n) / (1 + df)) + 1
    rows = sample(training)
    langs, w, temperature = train(rows, idf) if rows else ([], np.zeros(((1 << BITS) + 1, 1)), 1.0)
    return predict(docs, langs, w, temperature, idf)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = identify(docs, docs.where(~held_out(F.col("doc_id"))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
