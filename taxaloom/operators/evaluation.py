"""Profiles, funnels, scores and comparisons of runs."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_frequency(df: DataFrame, column: str, stop: list[str], n: int, least: int = 4) -> DataFrame:
    """The n most frequent words of at least `least` letters; ties by name."""
    words = df.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit(f"[a-z]{{{least},}}"), F.lit(0))).alias("word"))
    return words.where(~F.col("word").isin(stop)).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(n)


def profile(df: DataFrame, key: str, columns: list[str], more: list[Column] | None = None) -> DataFrame:
    """Rows, distinct ids, blanks of each column, and more aggregates, in one pass."""
    blank = lambda c: F.btrim(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(" ")) == ""
    return df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("ids"), *(F.count_if(blank(c)).alias(f"blank_{c}") for c in columns), *(more or []))


def binned(value: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """The name of the first bin whose upper edge lies above the value."""
    out = F.lit(last)
    for edge, name in reversed(edges):
        out = F.when(value < edge, F.lit(name)).otherwise(out)
    return out


def colour_bin(value: Column, edges: list[float]) -> Column:
    """The place, from 0, of the last edge that the value reaches; -1 below the first."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= value)) - 1


def scores(df: DataFrame) -> DataFrame:
    """Weighted precision, recall and F1 of columns truth, said and weight; null where a denominator is zero."""
    some = lambda ok, name: F.sum(F.when(ok, F.col("weight")).otherwise(0.0)).alias(name)
    truth, said = F.col("truth"), F.col("said")
    t = df.agg(some(truth & said, "tp"), some(~truth & said, "fp"), some(truth & ~said, "fn"))
    return t.select(F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"), F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def differing(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of both runs whose values differ."""
    x, y = a.select(key, F.col(value).alias("first")), b.select(key, F.col(value).alias("second"))
    return x.join(y, key).where(~F.col("first").eqNullSafe(F.col("second")))


def funnel(df: DataFrame, steps: list[Column]) -> DataFrame:
    """Rows left after each step, in one pass; step0 is all."""
    met = [reduce(lambda a, b: a & b, steps[: i + 1]) for i in range(len(steps))]
    return df.agg(F.count("*").alias("step0"), *(F.count_if(m).alias(f"step{i}") for i, m in enumerate(met, 1)))


def combinations_of(df: DataFrame, flags: list[str], most: int, right: Column) -> DataFrame:
    """Rows and right ones for each conjunction of up to `most` true flags (not a cube: false flags ask for nothing)."""
    sets = [c for n in range(1, most + 1) for c in combinations(flags, n)]
    named = F.array_compact(F.array(*(F.when(reduce(lambda a, b: a & b, map(F.col, c)), F.lit("+".join(c))) for c in sets)))
    return df.select(F.explode(named).alias("features"), right.alias("__right")).groupBy("features").agg(F.count("*").alias("rows"), F.count_if("__right").alias("right"))


def counts_with_zeros(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Counts of a fixed list of values, zero where there are none."""
    listed = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return listed.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))
