import hashlib
import random
from collections import Counter

import numpy as np

from taxaloom.llm import order_minhash as om
from taxaloom.llm.common import documents, ship


def plain_signature(text):
    """The definition, one k-mer at a time."""
    h = om.kmers(om.points(text)).tolist()
    seen, slots = Counter(), {}
    for i, x in enumerate(h):
        u = int(om.mix64(np.array([x], np.uint64) + np.array([seen[x]], np.uint64) * om.M2)[0])
        seen[x] += 1
        slots.setdefault(u >> 58, []).append((u, i, x))
    out = [0] * om.SLOTS
    for slot, found in slots.items():
        kept = sorted((i, x) for _, i, x in sorted(found)[: om.TAKE])
        entry = 0
        for t in range(om.TAKE):
            entry = (entry * int(om.M4) + (kept[t][1] if t < len(kept) else 1)) % 2**64
        out[slot] = int(om.mix64(np.array([(entry + len(kept)) % 2**64], np.uint64))[0]) >> 32 | 1
    return out


def check(rows, out):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else om.NULL_ID), r[1] is not None, r[1] or ""))
    want = []
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        new = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        a, b, c = (om.signature(om.points(x)) for x in (t, new, after))
        want.append((str(d), len(t), hashlib.sha256(new.encode()).hexdigest(), a.astype(">u4").tobytes().hex(), b.astype(">u4").tobytes().hex(), om.likeness(a, b), om.likeness(a, c)))
    assert sorted((str(r[0]), *r[1:]) for r in out) == sorted(want)


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]
    out = om.op3_order_minhash(spark, sf_dir).collect()
    check(rows, out)
    assert np.mean([r.near_edited for r in out]) > 5 * np.mean([r.near_next for r in out])


def test_odd_rows(spark):
    ship(spark)
    rows = [(1, None), (2, ""), (5, "é" * 100), (5, "é" * 100), (None, "abc\U0001f600" * 30), (9, "ab"), (-3, "x y " * 3000), (8, "b")]
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, part string")
    check(rows, om.fingerprints(df).collect())
    check(rows[:1], om.fingerprints(df.where("doc_id = 1")).collect())
    assert om.fingerprints(df.limit(0)).collect() == []


def test_signature_is_the_definition():
    rnd = random.Random(3)
    for n in (1, 7, 8, 9, 60, 900, 9000):
        for letters in ("ab", "abcdefghij é"):
            t = "".join(rnd.choice(letters) for _ in range(n))
            assert om.signature(om.points(t)).tolist() == plain_signature(t)


def test_likeness_follows_edits_and_order():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    base = " ".join(words)
    sig = om.signature(om.points(base))
    last = 1.0
    for changed in (1, 10, 40, 120):
        w = list(words)
        for i in rnd.sample(range(len(w)), changed):
            w[i] = "zz" + w[i][::-1]
        now = om.likeness(sig, om.signature(om.points(" ".join(w))))
        assert now <= last
        last = now
    shuffled = [words[i : i + 8] for i in range(0, 400, 8)]
    rnd.shuffle(shuffled)
    assert om.likeness(sig, om.signature(om.points(" ".join(sum(shuffled, []))))) < 0.8
