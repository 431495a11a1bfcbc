import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from taxaloom.llm import packing
from taxaloom.llm.common import documents, ship


def test_plan_fills_and_never_overlaps():
    rnd = random.Random(1)
    for room in (8, 64, 1024):
        counts = {n: rnd.randrange(0, 40) for n in range(1, room + 1) if rnd.random() < 0.5}
        counts[room] = 3
        used, ranks = defaultdict(list), defaultdict(set)
        for length, rank, m, s, at in packing.plan(counts, room):
            for i in range(m):
                used[s + i].append((at, at + length))
                ranks[length].add(rank + i)
        assert {n: len(r) for n, r in ranks.items()} == {n: c for n, c in counts.items() if c}
        assert all(r == set(range(len(r))) for r in ranks.values())
        for spans in used.values():
            spans.sort()
            assert spans[0][0] == 0 and spans[-1][1] <= room
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        total = sum(n * c for n, c in counts.items())
        assert sorted(used) == list(range(len(used)))
        least = max(math.ceil(total / room), sum(c for n, c in counts.items() if 2 * n > room))
        assert len(used) <= least * 11 / 9 + 1  # the bound of best fit on descending lengths


def pieces(ids):
    n = math.ceil(len(ids) / 1024)
    head = len(ids) - 1024 * (n - 1)
    return [(0, ids[:head])] + [(head + 1024 * i, ids[head + 1024 * i : head + 1024 * (i + 1)]) for i in range(n - 1)]


def check(rows, out):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for d, t in rows:
        for k, (s, x) in enumerate(pieces(tok.encode(t or "", add_special_tokens=False).ids + [2])):
            want.append((d or -1, k, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    used = defaultdict(list)
    for r in out:
        used[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 1024
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    return len(used), sum(w[3] for w in want)


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]
    used, total = check(rows, packing.op6_best_fit_packing(spark, sf_dir).collect())
    assert used <= math.ceil(total / 1024) * 1.02 + 1


def test_odd_rows(spark):
    ship(spark)
    rows = [(1, None), (2, ""), (3, "x " * 9000), (3, "x " * 9000), (None, "abc"), (4, "a"), (5, " ".join(["q"] * 1023)), (6, " ".join(["q"] * 1024))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, packing.pack_documents(df, P.path("byte_bpe_50k.json")).collect())
    assert packing.pack_documents(df.limit(0), P.path("byte_bpe_50k.json")).collect() == []
