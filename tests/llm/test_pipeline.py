import os
import sys

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as p
import test_jaccard
import test_packing
import test_repeats
import test_secrets
from taxaloom.llm import quality
from taxaloom.llm.common import documents, materialise, ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    assert df.columns == COLUMNS
    return {r.doc_id: r.text for r in df.collect()}


def cut(rows):
    """Brute force of the third stage."""
    first, raw = {}, {d: t.encode() for d, t in rows.items()}
    for d in sorted(raw):
        for s in range(len(raw[d]) - 99):
            first.setdefault(raw[d][s : s + 100], (d, s))
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] < (d, s):
                gone[s : s + 100] = b"\1" * 100
        out[d] = bytes(x for x, g in zip(b, gone) if not g)
    return out


def masked(text):
    spans = sorted((a, b) for a, _, b in test_secrets.base(text) + test_secrets.entropy(text))
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_stages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scores = {r.doc_id: r.predicted for r in quality.op10_quality(spark, sf_dir).collect()}
    now = materialise(p.STAGES[0][1](spark, docs, sf_dir), "t")
    a = rows_of(now)
    assert set(a) == {d for d, x in scores.items() if x} and 0 < len(a) < docs.count()
    now = materialise(p.STAGES[1][1](spark, now, sf_dir), "t")
    b = rows_of(now)
    assert b == {d: a[d] for d, (_, c) in test_jaccard.brute(a.items()).items() if c == d}
    now = materialise(p.STAGES[2][1](spark, now, sf_dir), "t")
    c = rows_of(now)
    want = cut(b)
    assert set(c) == set(want)
    for d, raw in want.items():
        assert c[d] == raw.decode("utf-8", "replace") or c[d].replace("�", "") == raw.decode("utf-8", "ignore")
    now = materialise(p.STAGES[3][1](spark, now, sf_dir), "t")
    m = rows_of(now)
    assert m == {d: masked(t) for d, t in c.items()} and m != c
    test_packing.check(list(m.items()), p.STAGES[4][1](spark, now, sf_dir).collect())
    whole = p.run(spark, sf_dir).collect()
    assert {r.doc_id for r in whole} == set(m)


def test_odd_rows_pass_every_stage(spark, sf_dir):
    ship(spark)
    rows = [(900001, None, None, None, None, "a"), (900002, "", "en", "s", 0, "b"), (None, "one two three four five six", "en", "s", 27, "c"), (900003, "The of and to.\n" * 4000, "en", "s", 60000, "d"), (900003, "The of and to.\n" * 4000, "en", "s", 60000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for _, stage in p.STAGES[1:4]:
        out = materialise(stage(spark, docs, sf_dir), "odd")
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.collect()} == {900001, 900002, 900003, None}
    assert p.STAGES[0][1](spark, docs, sf_dir).columns == docs.columns
    for _, stage in p.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).collect() == []


def test_rows_without_an_id_stay_apart(spark, sf_dir):
    """Different texts without an id, or of one id, are different documents; equal ones are one."""
    ship(spark)
    text = lambda x: " ".join(f"{x}{i}" for i in range(60))
    rows = [(None, text("a"), "k"), (None, text("b"), "k"), (None, text("a"), "j"), (5, text("c"), "k"), (5, text("d"), "k"), (6, text("c") + " more", "k"), (7, text("e"), "k"), (7, text("e"), "k"), (None, None, "k"), (None, "", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = [(r.doc_id, r.text) for r in p.one_of_each_group(spark, docs, sf_dir).collect()]
    assert len(out) == 6  # both empty rows without an id are one
    assert sorted(t for _, t in out if t) == sorted([text("a"), text("b"), text("c"), text("d"), text("e")][:2] + [text("c"), text("d"), text("e")])
    cut = [(r.doc_id, r.text) for r in p.cut_repeats(spark, docs.where("text <> '' and (doc_id is null or doc_id = 5)"), sf_dir).collect()]
    assert sorted(t for _, t in cut) == sorted([text("a"), text("a"), text("b"), text("c"), text("d")])
