"""Readers with declared schemas. A text that does not fit its type stops the query."""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaloom.functions.dates import partial_timestamp
from taxaloom.functions.text import split_list


class SourceError(ValueError):
    """A file that is not as declared."""


def typed(column: str, kind: str) -> Column:
    """A text column as its declared kind: text, list, timestamp, or a SQL type."""
    c = F.nullif(F.col(column), F.lit(""))
    if kind == "text":
        return c
    if kind == "list":
        return split_list(c)
    if kind == "timestamp":
        return partial_timestamp(c)
    return c.cast(kind)


def delimited(spark: SparkSession, path: str, columns: dict[str, str], sep: str = "\t") -> DataFrame:
    """A file with a heading and no quoting; columns are found whatever their case, read as text and cast."""
    raw = spark.read.option("sep", sep).option("quote", "").option("escape", "").option("header", True).option("nullValue", "").csv(path)
    there = {c.lower(): c for c in raw.columns}
    missing = [c for c in columns if c.lower() not in there]
    if missing:
        raise SourceError(f"{path} lacks {', '.join(missing)}")
    return raw.select(*(F.col(f"`{there[c.lower()]}`").alias(c.lower()) for c in columns)).select(*(typed(c.lower(), k).alias(c.lower()) for c, k in columns.items()))


def headless(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """A typed file without heading; short rows are filled with nulls."""
    return spark.read.option("sep", sep).option("quote", "").option("escape", "").option("mode", "PERMISSIVE").schema(schema).csv(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file with their numbers from 1, in file order: the file is one row until it is cut."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n", -1)).alias("n", "line")).select((F.col("n") + 1).alias("file_row"), "line")


def numbered_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A delimited file with heading whose rows keep their place; only empty is null."""
    lines = numbered_lines(spark, path)
    head = lines.where("file_row = 1").first()
    if head is None:
        raise SourceError(f"{path} is empty")
    names = head.line.split(sep)
    cells = F.split("line", rf"\Q{sep}\E", -1)
    return lines.where("file_row > 1").select((F.col("file_row") - 1).alias("file_row"), *(F.nullif(F.get(cells, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)))


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def zip_members(spark: SparkSession, path: str, ending: str) -> DataFrame:
    """Members of zip archives as rows (archive, member, content), unpacked on the executors."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for name, raw in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    for member in sorted(z.namelist()):
                        if member.endswith(ending):
                            yield pd.DataFrame({"archive": [name], "member": [member], "content": [z.read(member)]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, member string, content binary")


def archive_table(spark: SparkSession, path: str, encodings: tuple[str, ...] = ("utf-8-sig", "latin-1")) -> DataFrame:
    """A CSV in the first encoding that fits, headings tidied, rows whose Year is no number left out."""
    raw = bytes(spark.read.format("binaryFile").load(path).first().content)
    for e in encodings:
        try:
            frame = pd.read_csv(io.BytesIO(raw), encoding=e, dtype=str, keep_default_na=False)
            break
        except UnicodeDecodeError:
            continue
    else:
        raise SourceError(f"{path} is in none of {', '.join(encodings)}")
    return _tidy(spark, frame, path).where(F.col("year").try_cast("int").isNotNull())


def sheet(spark: SparkSession, path: str, name: str | int = 0) -> DataFrame:
    """A spreadsheet's cells as text; needs a reader for the format."""
    try:
        frame = pd.read_excel(path, sheet_name=name, dtype=str, keep_default_na=False)
    except ImportError as e:
        raise SourceError("no spreadsheet reader is installed") from e
    return _tidy(spark, frame, path)


def _tidy(spark: SparkSession, frame: pd.DataFrame, path: str) -> DataFrame:
    names = [" ".join(str(c).replace(" ", " ").split()).lower().replace(" ", "_") for c in frame.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise SourceError(f"{path} has {', '.join(twice)} more than once")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = [tuple(" ".join(x.replace(" ", " ").split()) or None for x in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, schema)


def hand_list(spark: SparkSession, rows: list[dict[str, str]], key: list[str], allowed: dict[str, set[str]] | None = None) -> DataFrame:
    """A short list kept by hand: repeated or blank keys and unknown values are refused."""
    seen = set()
    for r in rows:
        k = tuple(r.get(c) or "" for c in key)
        if not all(x.strip() for x in k):
            raise SourceError(f"a row of the list has no {', '.join(key)}")
        if k in seen:
            raise SourceError(f"{', '.join(k)} is in the list twice")
        seen.add(k)
        for c, values in (allowed or {}).items():
            if r.get(c) not in values:
                raise SourceError(f"{r.get(c)!r} is no {c}")
    names = list(rows[0]) if rows else key
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], T.StructType([T.StructField(n, T.StringType()) for n in names]))


def answers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with file and place; lines that are no JSON are left out.

    A place is where the line's part of the file starts and the line's number in that part, so places
    are in file order however a file is split.
    """
    kept = T.StructType.fromDDL(schema).add("_corrupt_record", "string")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("line")).alias("place"))
    rows = lines.where(F.btrim("value") != "").select(F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("row"), "file", "place")
    return rows.where("row._corrupt_record is null").select("row.*", "file", "place").drop("_corrupt_record")


def first_valid(rows: DataFrame, valid: Column) -> DataFrame:
    """The first line of each id that passes."""
    w = Window.partitionBy("id").orderBy("file", "place")
    return rows.where(valid).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def latest_answer(rows: DataFrame, answered: Column, finished: str) -> DataFrame:
    """Of each id an answered line before others, then the one finished last, then the later line."""
    w = Window.partitionBy("id").orderBy(answered.desc(), F.desc_nulls_last(finished), F.desc("file"), F.desc("place"))
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def dataset_xml(documents: DataFrame) -> DataFrame:
    """Title, citation, licence and DOI of dataset descriptions (datasetkey, xml)."""
    at = lambda p: F.nullif(F.btrim(F.xpath_string("xml", F.lit(p)), F.lit(" \n\t")), F.lit(""))
    rights = F.coalesce(at("//dataset/intellectualRights//ulink/@url"), at("//dataset/intellectualRights"))
    return documents.select("datasetkey", at("//dataset/title").alias("title"), at("//dataset/creator/organizationName").alias("publisher"), at("//additionalMetadata//citation").alias("citation"), rights.alias("license"), F.regexp_extract(F.coalesce(at("//dataset/alternateIdentifier[contains(., '10.')]"), F.lit("")), r"(10\.\S+)", 1).alias("doi"))


def record_xml(documents: DataFrame) -> DataFrame:
    """Title, subjects, points and boxes of catalogue records (id, xml)."""
    one = lambda p: F.nullif(F.xpath_string("xml", F.lit(p)), F.lit(""))
    many = lambda p: F.xpath("xml", F.lit(p + "/text()"))
    edges = [many(f"//geoLocationBox/{e}") for e in ("westBoundLongitude", "southBoundLatitude", "eastBoundLongitude", "northBoundLatitude")]
    boxes = F.transform(F.arrays_zip(*(e.alias(n) for e, n in zip(edges, "wsen", strict=True))), lambda x: F.struct(*(x[n].try_cast("double").alias(n) for n in "wsen")))
    points = F.transform(F.arrays_zip(many("//geoLocationPoint/pointLatitude").alias("lat"), many("//geoLocationPoint/pointLongitude").alias("lon")), lambda x: F.struct(x["lat"].try_cast("double").alias("lat"), x["lon"].try_cast("double").alias("lon")))
    return documents.select("id", one("//titles/title").alias("title"), many("//subjects/subject").alias("subjects"), one("//dates/date[@dateType='Issued']").alias("issued"), many("//rightsList/rights").alias("rights"), points.alias("points"), boxes.alias("boxes"))


def boxes_of_documents(documents: DataFrame) -> DataFrame:
    """A row for each bounding box of a document (id, xml), with a flag for an edge that is missing or no number."""
    names = ["westBoundingCoordinate", "southBoundingCoordinate", "eastBoundingCoordinate", "northBoundingCoordinate"]
    edges = [F.xpath("xml", F.lit(f"//boundingCoordinates/{n}/text()")) for n in names]
    rows = documents.select("id", F.posexplode(F.arrays_zip(*(e.alias(n) for e, n in zip(edges, "wsen", strict=True)))).alias("box", "e"))
    values = {n: F.col(f"e.{n}").try_cast("double") for n in "wsen"}
    return rows.select("id", "box", *(v.alias(n) for n, v in values.items()), (values["w"].isNull() | values["s"].isNull() | values["e"].isNull() | values["n"].isNull()).alias("damaged"))


def in_box(spark: SparkSession, path: str, columns: list[str], box: tuple[float, float, float, float], lon: str = "decimallongitude", lat: str = "decimallatitude") -> DataFrame:
    """Columns of the parquet rows whose point lies in a box (west, south, east, north); the bounds reach the files' statistics."""
    west, south, east, north = box
    inside = F.col(lon).between(float(west), float(east)) & F.col(lat).between(float(south), float(north))
    return spark.read.parquet(path).where(inside).select(*columns)


def cell_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small CSV with heading that may be gzipped whatever its name: its first two bytes say so."""
    names = [f.name for f in T.StructType.fromDDL(schema)]

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                text = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                yield pd.read_csv(io.BytesIO(text), dtype=str, keep_default_na=False)[names]

    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, ", ".join(f"{n} string" for n in names))
    return rows.select(*(F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)))
