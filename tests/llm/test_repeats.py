import hashlib
import random

import pytest
from pyspark.sql import functions as F

from taxaloom.llm import repeats
from taxaloom.llm.common import ship


def brute(rows, length=100):
    """rows: (doc_id, digest, text) -> {row: (n_bytes, n_removed, n_spans, sha)}; equal rows are repeats."""
    first, out = {}, {}
    texts = {(d if d is not None else 2**63 - 1, x): (t or "").encode() for d, x, t in rows}
    for d in sorted(texts):
        b = texts[d]
        for s in range(len(b) - length + 1):
            first.setdefault(b[s : s + length], (d, s))
    for d, b in texts.items():
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < (d, s):
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def digests(df):
    return [tuple(r) for r in df.select("doc_id", F.xxhash64("text"), "text").collect()]


def run(df):
    out = repeats.remove_repeats(df.select("doc_id", "text"))
    gone = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    key = F.coalesce("doc_id", F.lit(2**63 - 1))
    return [((r[0], r[1]), tuple(r[2:])) for r in out.select(key, F.xxhash64("text"), F.length("kept") + gone, gone, F.size("removed_spans"), F.sha2("kept", 256)).collect()]


def check(spark, rows):
    ship(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(digests(df))
    got = run(df)
    assert len(got) == len(rows)
    for d, r in got:
        assert r == want[d], d


def test_documents(spark, sf_dir):
    from taxaloom.llm.common import documents

    want = {d: r for (d, _), r in brute(digests(documents(spark, sf_dir))).items()}
    got = {r[0]: tuple(r[1:]) for r in repeats.op1_suffix_repeats(spark, sf_dir).collect()}
    assert got == want
    assert sum(r[1] for r in want.values()) > 0


def test_odd_cases(spark):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefgh é\n") for _ in range(700))
    hot = "".join(rnd.choice("xyz ") for _ in range(260))
    rows = [(5, base), (3, base[100:480]), (7, base[:150] + "#" + base[150:]), (8, None), (9, ""), (10, "short"), (11, "a" * 1000), (12, "ab" * 400), (None, base[40:300]), (13, "a" * 99), (14, "a" * 100)]
    rows += [(i, "".join(rnd.choice("klmnop") for _ in range(rnd.randrange(0, 120))) + hot + "".join(rnd.choice("klmnop") for _ in range(90))) for i in range(100, 180)]
    rows += [(200, base), (200, base), (2, hot), (2, hot)]
    check(spark, rows)


@pytest.mark.parametrize("hot", [1, 4096])
def test_small_flushes(spark, monkeypatch, hot):
    """Several batches, each ordered on its own, give what one gives."""
    monkeypatch.setattr(repeats, "FLUSH", 1)
    monkeypatch.setattr(repeats, "HOT", hot)
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(2, 9))) for _ in range(40)]
    parts = [" ".join(rnd.choice(words) for _ in range(40)) for _ in range(12)]
    check(spark, [(i, " ".join(rnd.choice(parts) for _ in range(4))) for i in range(120)])


def test_empty(spark):
    check(spark, [])


def test_columns_pass_through(spark):
    ship(spark)
    df = spark.createDataFrame([("k", 1, "x" * 300, 7, "m")], "kept string, doc_id long, text string, doc_key int, marks string")
    r = repeats.remove_repeats(df, kept="kept2").collect()[0]
    assert (r.kept, r.doc_id, r.doc_key, r.marks) == ("k", 1, 7, "m")
    assert len(r.kept2) == 100 - 0 or len(r.kept2) >= 1


def test_length_bound(spark):
    with pytest.raises(ValueError):
        repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length=50)


def test_long_texts_go_in_stretches(spark, monkeypatch):
    """What is cut at stretch borders is settled all the same."""
    monkeypatch.setattr(repeats, "CHUNK", 257)
    rnd = random.Random(9)
    base = "".join(rnd.choice("abcdefgh \n") for _ in range(2600))
    rows = [(1, base), (2, base[300:1900] + "#" + base[700:2300]), (3, base[::-1] + base[:500])]
    held = []
    import numpy as np
    import pyarrow as pa

    for batch in repeats.anchor_rows(100, 10**9)(iter([pa.record_batch([pa.array([r[0] for r in rows]), pa.array([0, 0, 0]), pa.array([r[1] for r in rows])], names=["d", "x", "t"])])):
        held.append(batch)
    assert sum(len(b) for b in held) > 0 and max(int(np.max(b.column(4).to_numpy() >> 32)) for b in held) > 1000
    check(spark, rows)


def test_repeated_and_missing_ids(spark):
    """A row loses what an earlier row has, whatever other rows of its id lose."""
    rnd = random.Random(11)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    p, a, b = text(150), text(600), text(700)
    rows = [(1, p), (None, a), (None, b[:300] + p + b[300:]), (7, a[:50] + b[:200]), (7, text(500)), (7, p + text(90)), (7, p + "!"), (None, p), (None, None), (None, a)]
    check(spark, rows)


def test_factors_are_the_longest():
    """Lengths, not only what is cut, as in a quadratic version."""
    import numpy as np

    rnd = random.Random(12)
    for n, kinds, cap in ((400, "ab", 100), (600, "abc", 97), (500, "a", 100), (300, "abcdefgh", 128), (700, "ab", 200)):
        part = "".join(rnd.choice(kinds) for _ in range(n // 3))
        raw = (part + "".join(rnd.choice(kinds) for _ in range(n // 5)) + part + part[: n // 4] + "#" * cap).encode()
        at = np.array(rnd.sample(range(len(raw) - cap), min(200, len(raw) - cap)))
        place = np.array([rnd.randrange(150) for _ in at])
        want = [max((next((k for k in range(cap) if raw[i + k] != raw[j + k]), cap) for j, q in zip(at.tolist(), place.tolist()) if q < p), default=0) for i, p in zip(at.tolist(), place.tolist())]
        data = np.frombuffer(raw, np.uint8)
        assert repeats.previous_factors(data, at, place, cap).tolist() == want
        assert (repeats.previous_factors(data, at, place, cap, cap) >= cap).tolist() == [x >= cap for x in want]


def peak_mb(rows):
    """The most that a worker's function holds while it runs, beyond what was there, and how many rows it gives at once."""
    import tracemalloc

    tracemalloc.start()
    try:
        most = max(len(b) for b in rows)
        return tracemalloc.get_traced_memory()[1] / 1e6, most
    finally:
        tracemalloc.stop()


def text_batch(texts):
    import pyarrow as pa

    return pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts)], names=["d", "x", "t"])


@pytest.mark.parametrize("texts", [["a" * 5_000_000], ["a" * 400_000 + str(i) for i in range(12)], ["".join(random.Random(2).choices("abcdefgh", k=4_000_000))]])
def test_anchors_have_bounded_memory(texts):
    """Each byte of a run of one byte is an anchor: they are ordered in parts, within a long text too."""
    mb, most = peak_mb(repeats.anchor_rows(100, repeats.FLUSH)(iter([text_batch(texts)])))
    assert mb < 350
    assert most <= repeats.SENT


def test_anchors_in_parts_give_what_one_order_gives(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HELD", 40)
    monkeypatch.setattr(repeats, "SENT", 7)
    monkeypatch.setattr(repeats, "CHUNK", 300)
    rnd = random.Random(13)
    base = "".join(rnd.choice("abc") for _ in range(900)) + "z" * 700
    check(spark, [(i, base[i * 31 :] + "y" * (90 + i) + base[: i * 57]) for i in range(9)])


def test_many_ranges_of_one_batch_have_bounded_memory():
    """The bytes of a batch's ranges are taken in parts of CHUNK bytes."""
    import pyarrow as pa

    n = 190_000
    text = "".join(random.Random(1).choices("abcdefgh", k=40 * n + 200))
    at = pa.array([40 * i for i in range(n)], pa.int32())
    ranges = pa.StructArray.from_arrays([at, pa.array([60] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([False] * n)], ["s", "w", "h", "hot"])
    marks = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ranges)
    batch = pa.record_batch([pa.array([1], pa.int64()), pa.array([0], pa.int64()), pa.array([text]), marks], names=["d", "x", "t", "m"])
    got = []
    mb, _ = peak_mb(got.append(b.column(7)[0].as_py() + b.column(7)[len(b) - 1].as_py()) or b for b in repeats.window_rows(0, 1, 2, 3, 100)(iter([batch])))
    assert mb < 100
    assert got[0][:160] == text[:160].encode() and got[-1][160:] == text[40 * (n - 1) : 40 * (n - 1) + 160].encode()
