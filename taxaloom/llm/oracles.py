"""DuckDB SQL for the corpus queries that SQL can express: plain definitions, without the operators' methods."""

from __future__ import annotations

from . import licences, secrets

UPPER, LOWER = licences.UPPER, licences.LOWER


def repeats(length: int = 100) -> str:
    """Every window with its first place; bytes as two hexadecimal digits."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, {2 * length}) AS x FROM (SELECT doc_id, h, unnest(generate_series(0, n - {length})) AS s FROM d WHERE n >= {length})),
f AS (SELECT x, min((doc_id, s)) AS first FROM w GROUP BY x),
r AS (SELECT w.doc_id, w.s FROM w JOIN f ON w.x = f.x WHERE (w.doc_id, w.s) > f.first),
g AS (SELECT doc_id, s, CASE WHEN s > lag(s) OVER o + {length} OR lag(s) OVER o IS NULL THEN 1 ELSE 0 END AS new FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
i AS (SELECT doc_id, min(s) AS a, max(s) + {length} AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM g) GROUP BY doc_id, k),
k AS (SELECT d.doc_id, i.a, i.b, coalesce(lag(i.b) OVER (PARTITION BY d.doc_id ORDER BY i.a), 0) AS before, d.h FROM i JOIN d ON d.doc_id = i.doc_id),
t AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, coalesce(t.n_removed, 0) AS n_removed, coalesce(t.n_spans, 0) AS n_spans, sha256(unhex(coalesce(t.kept, d.h))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id"""


def jaccard() -> str:
    """All pairs that share a shingle, counted; links closed by recursion; class: the smallest document with the same set."""
    return rf"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(x, chr(10) ORDER BY x)) AS h FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(d, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.d, l.b FROM r JOIN l ON l.a = r.m)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(min(n.doc_id) OVER (PARTITION BY n.n, n.h), t.doc_id) AS class_id, c.component_id
FROM t LEFT JOIN n ON n.doc_id = t.doc_id JOIN (SELECT d, min(m) AS component_id FROM r GROUP BY d) c ON c.d = t.doc_id
WHERE n.doc_id IS NOT NULL
UNION ALL SELECT doc_id, 0, doc_id, doc_id FROM t WHERE len(w) = 0"""


def secret_spans() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"

    def found(kind: int, pattern: str, value: str) -> str:
        p = quote(pattern)
        return f"""SELECT doc_id, {kind} AS kind, i, m, v, CAST(sum(length(g)) OVER o + coalesce(sum(length(m)) OVER q, 0) AS BIGINT) AS a FROM (
            SELECT doc_id, unnest(regexp_extract_all(x, {p}, 0)) AS m, unnest(regexp_extract_all(x, {p}, {value})) AS v, unnest(list_slice(string_split_regex(x, {p}), 1, len(regexp_extract_all(x, {p}, 0)))) AS g, generate_subscripts(regexp_extract_all(x, {p}, 0), 1) AS i FROM d WHERE regexp_matches(x, {p}))
            WINDOW o AS (PARTITION BY doc_id ORDER BY i), q AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

    base = " UNION ALL ".join(f"SELECT doc_id, kind, a, a + length(m) AS b FROM ({found(k, p, v)}) WHERE {w}" for k, p, v, w in ((0, secrets.ASSIGN, "2", f"length(v) >= {secrets.ASSIGN_LEAST}"), (1, "AKIA[A-Z0-9]+", "0", "length(m) >= 18"), (2, "[0-9a-f]+", "0", "length(m) >= 16")))
    allowed = " AND ".join(f"NOT regexp_matches(m, {quote(p)})" for p in secrets.ALLOWED if r"\1" not in p)
    parts = []
    for k, (_, chars, shortest, width, least) in enumerate(secrets.CLASSES, 3):
        runs = f"SELECT doc_id, kind, i, m, a FROM ({found(k, f'[{chars}]{{{shortest},}}', '0')}) WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND {allowed}"
        windows = f"SELECT doc_id, kind, i, a + j AS s FROM (SELECT *, unnest(generate_series(0, length(m) - {width})) AS j FROM ({runs})) WHERE list_aggregate(string_split(substr(m, j + 1, {width}), ''), 'entropy') >= {least} - 1e-9"
        marked = f"SELECT *, CASE WHEN s > lag(s) OVER o + {width} OR lag(s) OVER o IS NULL THEN 1 ELSE 0 END AS new FROM ({windows}) WINDOW o AS (PARTITION BY doc_id, i ORDER BY s)"
        parts.append(f"SELECT doc_id, kind, min(s) AS a, max(s) + {width} AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id, i ORDER BY s) AS g FROM ({marked})) GROUP BY doc_id, kind, i, g")
    name = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secrets.KINDS)) + " END"
    listed = f"string_agg({name} || ':' || a || ':' || b, ',' ORDER BY a, kind)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents), base AS ({base}), more AS ({' UNION ALL '.join(parts)}),
b AS (SELECT doc_id, {listed} AS t, count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2 FROM base GROUP BY doc_id),
e AS (SELECT doc_id, {listed} AS t FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(b.t, '')) AS base_sha256, coalesce(e.t, '') AS spans
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN e ON e.doc_id = d.doc_id"""


ORACLE_SQL = {"op1_suffix_repeats": repeats(), "op2_ngram_jaccard": jaccard(), "op4_secret_scan": secret_spans(), "op8_license_scan": licences.oracle()}
