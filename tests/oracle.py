"""Spark's rows against DuckDB's, as sorted lists of values by column name."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return repr(x)


def compare(df, con, sql):
    """Problems found, as text; empty if the two agree."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} against {sorted(rel.columns)}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    same = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}
    odd = [f"{c}: {t} against {types[c]}" for c, t in df.dtypes if same.get(types[c]) != t.replace("_ntz", "")]
    cols = sorted(df.columns)
    a = sorted(tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect())
    b = sorted(tuple(plain(x) for x in r) for r in rel.select(*(f'"{c}"' for c in cols)).fetchall())
    if a != b:
        only_a, only_b = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"{len(a)} rows against {len(b)}; spark alone {only_a}; duckdb alone {only_b}"
    return "types " + ", ".join(odd) if odd else ""
