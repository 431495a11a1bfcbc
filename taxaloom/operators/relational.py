"""Relational helpers: best row per key, reports of filters, table differences, facets, key rewrites, components."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.plans.shared import _system, scratch_root


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key; Catalyst limits each task's groups before the shuffle."""
    rank = "__rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n).drop(rank)


def ordinal(df: DataFrame, keys: list[str], order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Numbers rows within their key."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) + F.lit(start - 1)).cast("int"))


def first_failure(conditions: dict[str, Column], passed: str = "kept") -> Column:
    """The name of the first condition that a row does not meet; a condition that is null is not met."""
    out = F.lit(passed)
    for name, ok in reversed(list(conditions.items())):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def failure_report(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows by the first filter that removes them."""
    return df.groupBy(first_failure(conditions).alias("reason")).agg(F.count("*").alias("records"))


def drop_report(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """In one pass: rows that each filter alone would remove, and rows that pass all."""
    met = {name: F.coalesce(ok, F.lit(False)) for name, ok in conditions.items()}
    every = reduce(lambda a, b: a & b, met.values())
    return df.agg(F.count("*").alias("total"), *(F.count_if(~ok).alias(name) for name, ok in met.items()), F.count_if(every).alias("kept"))


def apply_filters(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, conditions.values()))


def rewrite_key(df: DataFrame, merge: DataFrame, key: str, original: str) -> DataFrame:
    """Keys that were merged replaced by the kept key (one step), the old key in `original`.

    `merge` has old_key and kept_key. The join needs no hint: a small table is broadcast by its size, a
    large one is not.
    """
    m = merge.select(F.col("old_key").alias("__old"), F.col("kept_key").alias("__kept"))
    out = df.withColumn(original, F.col(key)).join(m, F.col(original) == F.col("__old"), "left")
    return out.withColumn(key, F.coalesce("__kept", original)).drop("__old", "__kept")


def difference(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """gained, lost, changed or unchanged for each key of either table; columns are compared null-safely."""
    o = old.select(F.col(key), F.struct(*columns).alias("__o"))
    n = new.select(F.col(key), F.struct(*columns).alias("__n"))
    status = F.when(F.col("__o").isNull(), "gained").when(F.col("__n").isNull(), "lost").when(F.col("__o").eqNullSafe(F.col("__n")), "unchanged").otherwise("changed")
    return o.join(n, key, "full_outer").select(key, status.alias("status"))


def unequal_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, with their side; repeated rows count."""
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def fill_years(df: DataFrame, year: str, count: str) -> DataFrame:
    """A row for every year between the first and the last, zero where there is none."""
    span = df.where(F.col(year).isNotNull()).agg(F.min(year).alias("a"), F.max(year).alias("b")).where("a is not null")
    years = span.select(F.explode(F.sequence("a", "b")).alias(year))
    return years.join(df.select(year, count), year, "left").select(year, F.coalesce(count, F.lit(0)).alias(count))


def facet_counts(df: DataFrame, conditions: dict[str, Column], facets: dict[str, Column]) -> DataFrame:
    """One pass over df: for each facet and value, the rows that meet every condition but the facet's own.

    facets: by the name of the condition that a facet leaves out.
    """
    flags = {name: F.coalesce(ok, F.lit(False)) for name, ok in conditions.items()}
    rest = lambda name: reduce(lambda a, b: a & b, (f for n, f in flags.items() if n != name), F.lit(True))
    cells = F.array(*(F.struct(F.lit(name).alias("facet"), value.cast("string").alias("value"), rest(name).alias("ok")) for name, value in facets.items()))
    return df.select(F.inline(cells)).where("ok").groupBy("facet", "value").agg(F.count("*").alias("datasets"))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 0, by: list[str] | None = None) -> DataFrame:
    """n rows by the order of a seeded digest, of each stratum if `by` is given; the same rows every time."""
    order = [F.md5(F.concat_ws(" ", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)]
    return top_per_key(df, by, order, n) if by else df.orderBy(*order).limit(n)


def pass_through_disk(df: DataFrame, name: str) -> DataFrame:
    """df written to the folder that driver and executors share, and read back."""
    path = f"{scratch_root(df.sparkSession)}/taxaloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._taxaloom_path = path
    return out


def remove(*frames: DataFrame) -> None:
    """Delete what pass_through_disk() wrote for frames that nobody reads any more."""
    for df in frames:
        fs, path = _system(df.sparkSession, df._taxaloom_path)
        fs.delete(path, True)


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, comp): roots hook to their smallest neighbour and links are redrawn between roots until none is left."""
    live = pass_through_disk(links.select("a", "b").where("a <> b").distinct(), "links")
    nodes = pass_through_disk(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("comp", F.col("node")), "nodes")
    done = []
    while not live.isEmpty():
        hook = live.union(live.select("b", "a")).groupBy(F.col("a").alias("u")).agg(F.min("b").alias("p")).select("u", F.least("u", "p").alias("p"))
        parent = pass_through_disk(hook.join(hook.select(F.col("u").alias("p"), F.col("p").alias("pp")), "p").select("u", F.col("pp").alias("p")), "parents")
        done += [live, nodes, parent]
        to = lambda c, name, p=parent: p.select(F.col("u").alias(c), F.col("p").alias(name))
        live = pass_through_disk(live.join(to("a", "x"), "a").join(to("b", "y"), "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        nodes = pass_through_disk(nodes.join(to("comp", "q"), "comp", "left").select("node", F.coalesce("q", "comp").alias("comp")), "nodes")
        remove(*done)
        done = []
    remove(live)
    return nodes
