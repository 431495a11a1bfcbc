"""Writers: checked publication, byte-stable files, exports with their own description."""

from __future__ import annotations

import csv
import gzip
import io
import json
import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


class CheckFailed(RuntimeError):
    """A check found rows; nothing was replaced."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(tables: dict[str, DataFrame], root: str, checks: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]) -> None:
    """Write tables beside their places, run checks on what was written, and only then put them into place.

    The tables that were there are kept until all new ones stand; if one can't be put into place, they
    come back and nothing has changed.
    """
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    stage = f"{root}/.stage-{uuid.uuid4().hex}"
    written, moved = {}, []
    try:
        for name, df in tables.items():
            df.write.option("compression", "zstd").parquet(f"{stage}/{name}")
            written[name] = spark.read.schema(df.schema).parquet(f"{stage}/{name}")
        failed = [name for name, rows in checks(written).items() if not rows.isEmpty()]
        if failed:
            raise CheckFailed(", ".join(failed))
        for name in tables:
            new, fs = _fs(spark, f"{stage}/{name}")
            old, _ = _fs(spark, f"{root}/{name}")
            aside, _ = _fs(spark, f"{stage}/old-{name}")
            there = fs.exists(old)
            if there and not fs.rename(old, aside):
                raise OSError(f"{name} could not be moved aside")
            moved.append((fs, old, aside if there else None))
            if not fs.rename(new, old):
                raise OSError(f"{name} could not be put into place")
    except BaseException:
        for fs, old, aside in reversed(moved):
            if fs.exists(old):
                fs.delete(old, True)
            if aside is not None:
                fs.rename(aside, old)
        raise
    finally:
        p, fs = _fs(spark, stage)
        fs.delete(p, True)


def sorted_parquet(df: DataFrame, path: str, by: list[str]) -> None:
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").option("compression", "zstd").parquet(path)


def _lines(df: DataFrame, order: list[str]) -> Iterator[list]:
    for row in df.orderBy(*order).toLocalIterator(prefetchPartitions=True):
        yield ["" if x is None else x for x in row]


def stable_gzip_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """The same rows give the same bytes: sorted, no time and no name in the header. Rows stream through the driver."""
    part = f"{path}.part"
    with open(part, "wb") as raw, gzip.GzipFile(filename="", fileobj=raw, mode="wb", mtime=0) as z, io.TextIOWrapper(z, "utf-8", newline="") as text:
        out = csv.writer(text, lineterminator="\n")
        out.writerow(df.columns)
        out.writerows(_lines(df, order))
    os.replace(part, path)


def described_csv(df: DataFrame, order: list[str], header: list[str], names: dict[str, str] | None = None) -> Iterator[str]:
    """CSV text in pieces: a byte-order mark, lines that describe the export, headings, rows; lines end with CR LF."""
    buffer = io.StringIO()
    out = csv.writer(buffer, lineterminator="\r\n")
    buffer.write("﻿")
    for line in header:
        buffer.write("# " + " ".join(line.split()) + "\r\n")
    out.writerow([(names or {}).get(c, c) for c in df.columns])
    for row in _lines(df, order):
        out.writerow([_safe(x) for x in row])
        if buffer.tell() > 1 << 16:
            yield buffer.getvalue()
            buffer.seek(0)
            buffer.truncate()
    yield buffer.getvalue()


def _safe(x):
    """Lists joined; a text that a spreadsheet would take for a formula led by an apostrophe."""
    if isinstance(x, list):
        x = "; ".join(map(str, x))
    return "'" + x if isinstance(x, str) and x[:1] in ("=", "+", "-", "@") else x


def side_file(path: str, facts: dict) -> None:
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(facts, f, indent=2, sort_keys=True, ensure_ascii=False)
    os.replace(f"{path}.part", path)


def read_side_file(path: str) -> dict:
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def append_line(path: str, record: dict) -> None:
    """Append one JSON line and put it on disk; half a line that a stop has left is ended first."""
    repair_tail(path)
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(record, ensure_ascii=False) + "\n")
        f.flush()
        os.fsync(f.fileno())


def repair_tail(path: str) -> bool:
    """End a last line that has no line end, so that the next one stands alone."""
    if not os.path.exists(path) or not os.path.getsize(path):
        return False
    with open(path, "rb+") as f:
        f.seek(-1, os.SEEK_END)
        if f.read(1) == b"\n":
            return False
        f.write(b"\n")
    return True
