"""The folder that driver and executors share, and tables that are built there once."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only for a local master whose session names none, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="taxaloom-checkpoint")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def state_of(spark: SparkSession, paths: list[str]) -> str:
    """A digest of the names, sizes and times of all files under the paths."""
    seen = []
    for path in paths:
        fs, p = _system(spark, path)
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()[:24]


def served(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame], write: Callable[[DataFrame, str], None]) -> DataFrame:
    """The table that build() makes of the inputs: built if these very files were not seen before, read from then on.

    A table appears by one rename, so nobody reads half of one; whoever comes second takes the first one's.
    """
    path = f"{scratch_root(spark)}/taxaloom/served/{name}-{state_of(spark, inputs)}"
    fs, p = _system(spark, path)
    if not fs.exists(p):
        staged = f"{path}-{uuid.uuid4().hex}"
        write(build(), staged)
        _, q = _system(spark, staged)
        fs.deleteOnExit(p)
        if not fs.rename(q, p) or fs.exists(_system(spark, f"{path}/{q.getName()}")[1]):
            fs.delete(_system(spark, f"{path}/{q.getName()}")[1], True)
            fs.delete(q, True)
    return spark.read.parquet(path)
