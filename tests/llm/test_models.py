import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import langid, quality
from taxaloom.llm.common import documents, ship

WHERE = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    out = {r.doc_id: r for r in quality.op10_quality(spark, WHERE).collect()}
    assert set(out) == {r.doc_id for r in documents(spark, WHERE).select("doc_id").collect()}
    hit = n = 0
    for r in spark.read.parquet(f"{WHERE}/labels.parquet").collect():
        x = out[r.doc_id]
        assert x.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3)
        if x.held_out:
            hit, n = hit + (x.predicted == r.quality), n + 1
    assert hit / n > 0.9


def test_quality_odd_rows(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "x" * 50_000), (3, "x" * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, quality int")
    stats = quality.stats_of(docs)
    scores = quality.score_stats(stats, quality.fit(stats, labels)).collect()
    assert len(scores) == 5 and all(0 <= r.score <= 1 for r in scores)
    assert {r.score for r in quality.score_stats(stats, quality.fit(stats, labels.limit(0))).collect()} == {0.5}
    assert quality.score_stats(stats.limit(0), quality.fit(stats.limit(0), labels)).collect() == []
    wide = docs.withColumn("quality_score", F.lit(1)).withColumn("stats", F.lit("s"))
    assert quality.keep_good(wide, labels).columns == wide.columns


def test_pool_adjacent():
    y = np.array([0.1, 0.5, 0.3, 0.2, 0.9])
    assert np.allclose(quality.pool_adjacent(y, np.ones(5)), [0.1, 1 / 3, 1 / 3, 1 / 3, 0.9])


def test_normal_equations_are_ridge():
    rnd = np.random.default_rng(0)
    x = rnd.standard_normal((500, quality.STATS))
    z = quality.fourier(x, np.zeros(quality.STATS), np.ones(quality.STATS))
    k = z[:, :-1] @ z[:, :-1].T
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(k - np.exp(-d / 2 / quality.WIDTH**2)).mean() < 0.06


def test_languages_on_held_out_rows(spark):
    out = {r.doc_id: r for r in langid.op7_language_id(spark, WHERE).collect()}
    hit = n = 0
    for r in documents(spark, WHERE).collect():
        x = out[r.doc_id]
        assert x.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= x.score <= 1
        if x.held_out and r.lang is not None:
            hit, n = hit + (x.lang_pred == r.lang), n + 1
    assert hit / n > 0.95


@pytest.mark.parametrize("empty", [False, True])
def test_language_odd_rows(spark, empty):
    ship(spark)
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (3, None, "en"), (4, "123 !", "en"), (5, "abc", None), (None, "the dog", "en"), (2, "le chat", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(docs, docs.limit(0) if empty else docs).collect()
    assert len(out) == len(rows)
    got = {(r.doc_id, r.lang_pred) for r in out}
    assert {(3, "und"), (4, "und")} <= got
    assert all(p == "und" for _, p in got) if empty else (1, "en") in got and (2, "fr") in got
    assert langid.identify(docs.limit(0), docs).collect() == []


def plain_grams(text):
    """Feature -> count, a character at a time."""
    import unicodedata

    from taxaloom.llm.common import mix64

    text = (text or "").lower()
    letters = [unicodedata.category(c)[0] == "L" for c in text]
    if not any(letters):
        return None
    kept = [c if ok else " " for i, (c, ok) in enumerate(zip(text, letters)) if ok or (i and letters[i - 1])]
    x = [ord(c) for c in [" ", *kept, " "]]
    out = {}
    for k in (1, 2, 3):
        for i in range(len(x) - k + 1):
            h = sum(x[i + j] * int(langid.M[j]) for j in range(k)) % 2**64
            f = int(mix64(np.array([(h + k) % 2**64], np.uint64))[0]) >> (64 - langid.BITS)
            out[f] = out.get(f, 0) + 1
    return out


def test_languages_against_plain_ftrl(spark, monkeypatch):
    """Every prediction and score as of a slow version in dictionaries and loops."""
    import math

    from taxaloom.llm.common import documents

    monkeypatch.setattr(langid, "EPOCHS", 2)
    docs = documents(spark, "/root/testdata/sf0.001").where("lang is not null").orderBy("doc_id").limit(60).select("doc_id", F.substring("text", 1, 150).alias("text"), "lang").cache()
    got = {r.doc_id: r for r in langid.identify(docs, docs).collect()}
    rows = [(r.h, r.lang, plain_grams(r.text)) for r in docs.select("lang", "text", F.xxhash64("doc_id", "text").alias("h")).collect()]
    rows = sorted((r for r in rows if r[2]), key=lambda r: r[:2])
    df = {}
    for _, _, g in rows:
        for f in g:
            df[f] = df.get(f, 0) + 1

    def vector(g):
        v = {f: (1 + math.log(c)) * (math.log((1 + len(rows)) / (1 + df.get(f, 0))) + 1) for f, c in g.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {f: x / size for f, x in v.items()} | {-1: 1.0}

    langs = sorted({r[1] for r in rows})
    data = [(langs.index(r[1]), vector(r[2])) for r in rows]
    z, n = {}, {}

    def weight(f, k):
        a = z.get((f, k), 0.0)
        if abs(a) <= langid.L1:
            return 0.0
        return -(a - math.copysign(langid.L1, a)) / ((langid.BETA + math.sqrt(n.get((f, k), 0.0))) / langid.ALPHA + langid.L2)

    def logits(v):
        return [sum(x * weight(f, k) for f, x in v.items()) for k in range(len(langs))]

    def softmax(x):
        e = [math.exp(a - max(x)) for a in x]
        return [a / sum(e) for a in e]

    for _ in range(2):
        for i, (y, v) in enumerate(data):
            if i % 5 == 0:
                continue
            p = softmax(logits(v))
            for f, x in v.items():
                for k in range(len(langs)):
                    g, old = x * (p[k] - (k == y)), n.get((f, k), 0.0)
                    w = weight(f, k)
                    n[f, k] = old + g * g
                    z[f, k] = z.get((f, k), 0.0) + g - (math.sqrt(n[f, k]) - math.sqrt(old)) / langid.ALPHA * w
    kept = [(y, logits(v)) for i, (y, v) in enumerate(data) if i % 5 == 0]
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 93))
    t = min(grid, key=lambda t: sum(-math.log(softmax([a / t for a in x])[y]) for y, x in kept))
    for r in docs.collect():
        g = plain_grams(r.text)
        if g is None:
            assert got[r.doc_id].lang_pred == "und"
            continue
        p = softmax([a / t for a in logits(vector(g))])
        assert got[r.doc_id].lang_pred == langs[p.index(max(p))]
        assert abs(got[r.doc_id].score - max(p)) < 1e-4


def test_quality_against_a_plain_version(spark):
    """Every score as of a slow version: moments, kernel features, ridge by Gaussian elimination and pooling in loops."""
    import math

    ship(spark)
    docs = documents(spark, WHERE).select("doc_id", "text")
    labels = quality.training_labels(spark, WHERE)
    stats = quality.stats_of(docs).cache()
    model = quality.fit(stats, labels)
    got = {r.doc_id: r.score for r in quality.score_stats(stats, model).collect()}
    vectors = {r.doc_id: r.stats for r in stats.collect()}
    half = {r.doc_id: r.h for r in stats.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("h")).collect()}
    rows = [(r.doc_id, float(r.quality)) for r in labels.orderBy("doc_id").collect() if r.quality is not None and r.doc_id in vectors]
    m = len(rows)
    mean = [sum(vectors[d][i] for d, _ in rows) / m for i in range(quality.STATS)]
    scale = [math.sqrt(max(sum(vectors[d][i] ** 2 for d, _ in rows) / m - mean[i] ** 2, 0)) for i in range(quality.STATS)]
    scale = [x if x >= 1e-9 else 1.0 for x in scale]
    z = {d: quality.fourier(np.array([v]), np.array(mean), np.array(scale))[0] for d, v in vectors.items()}

    def ridge(of):
        a = np.zeros((quality.FEATURES + 1,) * 2)
        b = np.zeros(quality.FEATURES + 1)
        for d, y in rows:
            if half[d] in of:
                a += np.outer(z[d], z[d])
                b += z[d] * y
        a += quality.RIDGE * (m + 100) * np.eye(len(a))
        for i in range(len(a)):  # elimination without pivots: the matrix is positive definite
            for j in range(i + 1, len(a)):
                c = a[j, i] / a[i, i]
                a[j, i:] -= c * a[i, i:]
                b[j] -= c * b[i]
        x = np.zeros(len(a))
        for i in range(len(a) - 1, -1, -1):
            x[i] = (b[i] - a[i, i + 1 :] @ x[i + 1 :]) / a[i, i]
        return x

    from_other = {0: ridge((1,)), 1: ridge((0,))}
    bins = {}
    for d, y in rows:
        s = float(z[d] @ from_other[half[d]])
        k = min(max(int((s + 0.5) / 2 * quality.BINS), 0), quality.BINS - 1)
        c, t = bins.get(k, (0, 0.0))
        bins[k] = (c + 1, t + y)
    keys = sorted(bins)
    level = [[bins[k][1] / bins[k][0], bins[k][0], [k]] for k in keys]
    while True:
        bad = next((i for i in range(len(level) - 1) if level[i][0] >= level[i + 1][0]), None)
        if bad is None:
            break
        (v1, c1, k1), (v2, c2, k2) = level[bad : bad + 2]
        level[bad : bad + 2] = [[(v1 * c1 + v2 * c2) / (c1 + c2), c1 + c2, k1 + k2]]
    at = [-0.5 + (k + 0.5) * 2 / quality.BINS for k in keys]
    value = [v for v, _, ks in level for _ in ks]
    whole = ridge((0, 1))
    for d, v in z.items():
        s = float(v @ whole)
        want = float(np.interp(s, at, value))
        assert abs(got[d] - want) < 1e-6, d
