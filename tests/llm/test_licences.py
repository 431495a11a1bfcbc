import hashlib

import duckdb

from taxaloom.llm import licences
from taxaloom.llm.common import documents


def plain(rows):
    known = {d: n for n, d, _ in licences.known_digests()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for d, t in rows:
        lines = [x for x in map(licences.plain_line, (t or "").split("\n"))]
        lines = [x for x in lines if x and x != licences.RESERVED and not x.startswith(tuple(licences.NOTICES))]
        whole = digest(" ".join(lines))
        out.append((str(d), whole, str(known.get(whole)), ",".join(sorted({known[digest(x)] for x in lines if digest(x) in known}))))
    return sorted(out)


def check(rows, out):
    assert sorted((str(r.doc_id), r.canonical_sha256, str(r.license_id), r.notice_ids) for r in out) == plain(rows)


def test_documents_and_sql(spark, sf_dir):
    out = licences.op8_license_scan(spark, sf_dir).collect()
    check([tuple(r) for r in documents(spark, sf_dir).select("doc_id", "text").collect()], out)
    assert any(r.notice_ids for r in out)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(licences.oracle()).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out)


def test_variants_of_a_licence(spark):
    text = licences.KNOWN[0][1]
    rows = [(1, text), (2, "Copyright (c) 2020 Somebody\n\n" + text.upper()), (3, text.replace(",", " ,").replace("\n\n", "\n")), (4, text.replace("License", "Licence")), (5, text + " not"), (6, None), (7, ""), (None, "Licensed under CC BY-NC 4.0.\nmore"), (8, "x\n" * 20_000), (1, text)]
    out = licences.scan(spark.createDataFrame([(d, t, "q") for d, t in rows], "doc_id long, text string, license_id string")).collect()
    check(rows, out)
    assert {r.doc_id for r in out if r.license_id == "MIT"} == {1, 2, 3, 4}
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_known_table_of_the_caller(spark):
    known = spark.createDataFrame([("OWN", hashlib.sha256(b"my own terms").hexdigest())], "license_id string, digest string")
    out = licences.scan(spark.createDataFrame([(1, "My own terms."), (2, "a\nmy OWN, terms")], "doc_id long, text string"), known).collect()
    assert sorted((r.doc_id, r.license_id, r.notice_ids) for r in out) == [(1, "OWN", "OWN"), (2, None, "OWN")]


def test_every_known_text_in_other_clothes(spark):
    """Changed case, punctuation, line breaks, comment signs and copyright lines; none of a text with one word more."""
    rows, want = [], {}
    for name, text in licences.KNOWN:
        words = text.split(" ")
        bare = [x for x in text.split("\n") if x.strip()]
        for t in (text.upper(), "Copyright (c) 1999-2024 A. Person. All rights reserved.\n" + text, "\n".join("# " + x for x in text.split("\n")), "\n".join(bare).replace(",", " ; ")):
            want[len(rows)] = name
            rows.append((len(rows), t))
        if len(words) > 30:
            rows.append((len(rows), text + " indeed"))
            want[len(rows) - 1] = None
    out = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: r.license_id for d, r in out.items()} == want
    same = licences.scan(spark.createDataFrame([(1, "Copyright (c) 2020 Foo Bar. Licensed under the MIT License."), (2, "Copyright 2021 Foo"), (None, "MIT"), (None, "Released under the MIT License.\nx")], "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.license_id), r.notice_ids) for r in same) == [("1", "MIT", "MIT"), ("2", "None", ""), ("None", "None", ""), ("None", "None", "MIT")]


def test_published_texts():
    """The digests of long licences are those of the texts as a system installs them, where it does."""
    import pathlib

    where = pathlib.Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0-only": "GPL-2", "GPL-3.0-only": "GPL-3", "LGPL-2.1-only": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3", "MPL-2.0": "MPL-2.0"}
    known = {(name, digest) for name, digest, _ in licences.known_digests()}
    for name, file in files.items():
        if (where / file).exists():
            text = (where / file).read_text(encoding="utf-8")
            for t in (text, text.replace("\n\n", "\n"), text.upper()):
                assert (name, hashlib.sha256(licences.plain_text(t).encode()).hexdigest()) in known
