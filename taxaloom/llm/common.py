"""What the corpus operators share: reading, scratch tables, byte views of Arrow text, run helpers."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters or bytes that one vectorised step works on; bounds a worker's memory whatever the batch holds.
CHUNK = 500_000

#: Rows and bytes of a batch that goes to Python.
BATCH_ROWS, BATCH_BYTES = 2_500, 8_000_000

_SHIPPED: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that workers can import it wherever they start."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    # whole texts go to Python in batches of bounded size, whatever their length
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship"), "taxaloom_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only for a local master whose session names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="taxaloom-checkpoint")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/taxaloom/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _hadoop(spark, path, "deleteOnExit")
    out = spark.read.schema(df.schema).parquet(path)
    out._taxaloom_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete tables of materialise() that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_taxaloom_path", None)
        if path:
            _hadoop(df.sparkSession, path, "delete", True)


def _hadoop(spark: SparkSession, path: str, method: str, *args) -> None:
    """Call the file system that holds a path; tables nobody releases go when the application ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    getattr(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), method)(p, *args)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8_view(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array and n + 1 offsets into it; a null text has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = pc.fill_null(col, "").cast(pa.large_string())
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], np.int64, n + 1 + col.offset)[col.offset :]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data, offsets


def text_chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most `most` bytes each; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), in uint64 wrap-around arithmetic."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=8)
def byte_table(seed: int, size: int = 257) -> np.ndarray:
    """A fixed 64-bit word for each byte value, and one more that stands for what lies beyond a text."""
    return mix64(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def doc_key(df: DataFrame):
    """doc_id with null last: the order in which documents come."""
    return F.coalesce(df["doc_id"].cast("long"), F.lit(2**63 - 1))


def repeat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start + 1, ... of the given lengths."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not use, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name
