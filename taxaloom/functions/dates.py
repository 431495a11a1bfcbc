"""Partial dates and coordinate texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partial_start(col: Column) -> Column:
    """The first date of a date or range as text, without a closing Z; blank is null."""
    return F.nullif(F.rtrim(F.split_part(col, F.lit("/"), F.lit(1)), F.lit("Z")), F.lit(""))


def partial_timestamp(col: Column) -> Column:
    """Zone-free time of `1934`, `1965-09`, `2014-05-11T13:05`, a range's start or a time with Z; other texts stop the query."""
    return partial_start(col).cast("timestamp_ntz")


def try_time(col: Column) -> Column:
    """ISO 8601 time with or without a fraction; null where it cannot be read."""
    return F.try_to_timestamp(col)


def issued_year(col: Column) -> Column:
    return F.expr("1") * F.substring(F.nullif(col, F.lit("")), 1, 4).try_cast("int")


def decimals(col: Column) -> Column:
    """Decimal places that a coordinate was written with."""
    return F.length(F.regexp_extract(col.cast("string"), r"\.([0-9]+)$", 1))
