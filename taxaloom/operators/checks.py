"""Integrity checks: each is a DataFrame that must have no rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_columns(tables: dict[str, DataFrame], required: dict[str, list[str]]) -> list[str]:
    """All columns that tables lack, at once."""
    out = []
    for name, columns in required.items():
        there = set(tables[name].columns) if name in tables else set()
        out += [f"{name}.{c}" for c in columns if c not in there]
    return out


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))).select(*keys)


def several_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that should hold one value and hold more."""
    counts = df.agg(*(F.countDistinct(c).alias(c) for c in columns))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("values")) for c in columns)))).where(F.col("values") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys of the child, other than null, that the parent lacks."""
    return child.where(F.col(key).isNotNull()).select(key).distinct().join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def outside_domain(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("rows"))


def one_without_other(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows in which exactly one of two conditions holds."""
    t = lambda c: F.coalesce(c, F.lit(False))
    return df.where(t(a) != t(b))


def overlapping_keys(kept: DataFrame, key: str, merged: DataFrame, old: str) -> DataFrame:
    """Merged keys that are also kept: chains of merges."""
    return merged.select(F.col(old).alias(key)).distinct().join(kept.select(key), key, "left_semi")


def unequal_totals(totals: dict[str, DataFrame]) -> DataFrame:
    """Single-number frames that do not all agree."""
    parts = [df.select(F.lit(name).alias("name"), F.col(df.columns[0]).cast("bigint").alias("total")) for name, df in totals.items()]
    every = reduce(lambda a, b: a.unionByName(b), parts)
    whole = every.agg(F.min("total").alias("lo"), F.max("total").alias("hi"), F.collect_list(F.struct("name", "total")).alias("all"))
    return whole.where("lo <> hi").select(F.inline("all"))


def unequal_counts(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between two derivations, or that one lacks."""
    x, y = a.select(F.col(key), F.col(value).alias("a")), b.select(F.col(key), F.col(value).alias("b"))
    return x.join(y, key, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))


def not_once(groups: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Members that are in no group or in more than one."""
    counts = groups.groupBy(key).agg(F.count("*").alias("n"))
    return members.select(key).join(counts, key, "left").where("n is null or n <> 1")
