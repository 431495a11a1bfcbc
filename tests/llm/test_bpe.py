import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from taxaloom.llm import bpe
from taxaloom.llm.common import documents, ship

ODD = ["a" * 3000, "'s", "'", "x'll y", "''s", " 's", "ab" * 500, " " * 300, "", "can't've", "it's's", "'re", "'r", "<|endoftext|>", "\n\n x", "é  x", "\U0001f600" * 40]


def encoder(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def enc(voc, texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    ids, n, where = voc.encode_chunk(np.frombuffer(b"".join(raw), np.uint8), off)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    letters = list("  \n\t'stremvdl  aAé1²٣中_.!'’   ́\U0001f600ßſ\x1c\x85")
    return ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 40))) for _ in range(4000)]


def test_ranks_as_the_library(texts):
    want = encoder("byte_bpe_multi_50k.tiktoken")
    voc = bpe.Vocabulary(P.path("byte_bpe_multi_50k.tiktoken"))
    assert enc(voc, texts) == [want.encode_ordinary(t) for t in texts]
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    points = ["a" + c + "1" + c + " " + c for c in points]
    assert enc(voc, points) == [want.encode_ordinary(t) for t in points]


def test_merges_as_the_library(texts):
    want = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want.encode_special_tokens = True
    assert enc(bpe.Vocabulary(P.path("byte_bpe_50k.json")), texts) == [e.ids for e in want.encode_batch(texts, add_special_tokens=False)]


def test_query(spark, sf_dir):
    want = encoder("byte_bpe_multi_50k.tiktoken")
    got = {r.doc_id: r for r in bpe.op5_byte_bpe(spark, sf_dir).collect()}
    for r in documents(spark, sf_dir).collect():
        ids = want.encode_ordinary(r.text or "")
        x = got.pop(r.doc_id)
        assert x.n_tokens == len(ids)
        assert x.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert not got


def test_odd_rows(spark):
    ship(spark)
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = [(1, None, "x"), (1, "", "y"), (None, "a b", None), (2, "é " * 5000, "z"), (2, "é " * 5000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, path, ids="packed", offsets="at"), path, ids="packed", out="back").collect()
    assert sorted((r.doc_id or 0, r.text or "", r.ids or "") for r in out) == sorted((a or 0, b or "", c or "") for a, b, c in rows)
    for r in out:
        assert bytes(r.back).decode() == (r.text or "")
        assert len(r["at"]) == 2 * len(r.packed)
    assert bpe.encode(df.limit(0), path, ids="packed").collect() == []
    clash = bpe.decode(bpe.encode(df.withColumnRenamed("ids", "decoded"), path), path)
    assert clash.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(bytes(r.decoded).decode() for r in clash.collect()) == sorted(r[1] or "" for r in rows)


def test_decoding_refuses_unknown_ids():
    with pytest.raises(ValueError):
        bpe.Vocabulary(P.path("byte_bpe_multi_50k.tiktoken")).decode(np.array([50256]))


def test_long_texts_in_parts(monkeypatch):
    voc = bpe.Vocabulary(P.path("byte_bpe_multi_50k.tiktoken"))
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(["the", " ", " ", "'s", "é", "\n", "  ", "12", "a", " b"]) for _ in range(n)) for n in (3000, 5, 0, 9000)] + ["x" * 5000]
    want = enc(voc, texts)
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    whole = voc.encode_chunk(np.frombuffer(b"".join(raw), np.uint8), off)
    monkeypatch.setattr(bpe, "BYTES", 200)
    assert enc(voc, texts) == want
    parts = voc.encode_chunk(np.frombuffer(b"".join(raw), np.uint8), off)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_long_words_of_regular_build():
    """A Thue-Morse word and its complement come back as the bytes they were."""
    voc = bpe.Vocabulary(P.path("byte_bpe_multi_50k.tiktoken"))
    want = encoder("byte_bpe_multi_50k.tiktoken")
    x = "a"
    while len(x) < 4096:
        x += x.translate(str.maketrans("ab", "ba"))
        t = f"{x} {x.translate(str.maketrans('ab', 'ba'))} {x.translate(str.maketrans('ab', 'ba'))}"
        (ids,) = enc(voc, [t])
        assert ids == want.encode_ordinary(t)
        assert voc.decode(np.array(ids)).tobytes().decode() == t


@pytest.mark.parametrize("pieces", [["字", "漢", "。", "か"], ["ab", "12", "+", "/", "Z", "9"], ["it's", "'", "'s", " ", "'re1", "é", "\n", "  ", "-"], ["word ", "x's ", "1 2 "]])
def test_cuts_without_blanks(monkeypatch, pieces):
    """Texts of other scripts and of code are cut too, and encode as one."""
    rnd = random.Random(9)
    t = "".join(rnd.choice(pieces) for _ in range(6000))
    voc = bpe.Vocabulary(P.path("byte_bpe_multi_50k.tiktoken"))
    whole = enc(voc, [t, "x", t[:100]])
    monkeypatch.setattr(bpe, "BYTES", 500)
    raw = np.frombuffer(t.encode(), np.uint8)
    cuts = bpe.cut_points(raw, np.array([0, len(raw)]), 500, 64)
    assert np.diff(cuts).max() < 1500
    assert enc(voc, [t, "x", t[:100]]) == whole
    assert whole[0] == encoder("byte_bpe_multi_50k.tiktoken").encode_ordinary(t)


def test_one_run_stays_whole(monkeypatch):
    monkeypatch.setattr(bpe, "BYTES", 100)
    t = "q" * 3000
    assert enc(bpe.Vocabulary(P.path("byte_bpe_multi_50k.tiktoken")), [t]) == [encoder("byte_bpe_multi_50k.tiktoken").encode_ordinary(t)]
