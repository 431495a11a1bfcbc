"""The faceted dataset list: search columns, named conditions, orders, facets in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import text as tx
from taxaloom.operators.relational import facet_counts

#: What licences say about access.
OPEN_URI, RESTRICTED_URI = "info:eu-repo/semantics/openAccess", "info:eu-repo/semantics/restrictedAccess"
CHECKED_OPEN = ["open", "public"]
LEADING = r"^[\[(\"'“”‘’«»„ ]+"
SORTS = ["relevance", "newest", "oldest", "title"]


def search_columns(datasets: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """datasets with the columns that lists search and sort by."""
    start = F.regexp_replace(F.btrim(F.coalesce("title", F.lit("")), F.lit(" ")), LEADING, "")
    group = F.when(F.lower(tx.strip_accents(F.left(start, F.lit(1)))).rlike("^[a-z]"), 0).when(start.rlike("^[0-9]"), 1).otherwise(2)
    number = F.ltrim(F.regexp_extract(start, "^[0-9]+", 0), F.lit("0"))
    whole = F.concat_ws(" ", "title", "abstract", F.array_join("subjects", " "))
    said = lambda uri: F.exists(F.coalesce("licences", F.array().cast(dict(datasets.dtypes)["licences"])), lambda r: F.coalesce(r["uri"] == uri, F.lit(False)))
    access = F.when(said(OPEN_URI), "open").when(said(RESTRICTED_URI), "restricted").otherwise("")
    out = datasets.withColumns({
        "title_norm": F.concat(F.lit(" "), tx.search_norm(F.col("title"))), "title_group": group, "title_number": number, "text_norm": F.concat(F.lit(" "), tx.search_norm(whole)),
        "year": F.substring(F.nullif("issued", F.lit("")), 1, 4).try_cast("int"), "access": access,
    })
    if checks is None:
        return out
    found = checks.select(F.col("dataset_id").alias("id"), F.col("access").alias("__checked"), F.col("licences").alias("checked_licences"))
    return out.join(found, "id", "left").withColumn("access", F.when(F.col("__checked").isNotNull(), F.when(F.col("__checked").isin(CHECKED_OPEN), "open").otherwise("restricted")).otherwise(F.col("access"))).drop("__checked")


def words(query: str | None) -> list[str]:
    """Search words; the caller has them in search form."""
    return (query or "").split()


def conditions(query: list[str] | None = None, organism: str | None = None, catalogue: list[str] | None = None, final_class: list[str] | None = None, frontend_group: list[str] | None = None, access: list[str] | None = None, years: tuple[int | None, int | None] = (None, None), mappable: bool = False) -> dict[str, Column]:
    """Named conditions of a request; those not asked for are left out."""
    out: dict[str, Column] = {}
    if query:
        out["query"] = reduce(lambda a, b: a & b, (tx.has_word_starting(F.col("text_norm"), w) for w in query))
    if organism:
        out["organism"] = F.exists("organisms", lambda o: tx.has_word_starting(F.concat(F.lit(" "), tx.search_norm(o)), organism))
    for name, column, values in (("catalogue", "source", catalogue), ("final_class", "final_class", final_class), ("frontend_group", "frontend_group", frontend_group), ("access", "access", access)):
        if values:
            out[name] = F.col(column).isin(values)
    if years != (None, None):
        out["published"] = F.col("year").between(years[0] if years[0] is not None else -1, years[1] if years[1] is not None else 99999)
    if mappable:
        out["mappable"] = F.col("mappable")
    return out


def order(sort: str, query: list[str] | None = None) -> list[Column]:
    issued = F.nullif("issued", F.lit(""))
    if sort == "newest":
        return [F.desc_nulls_last(issued), F.col("id")]
    if sort == "oldest":
        return [F.asc_nulls_last(issued), F.col("id")]
    if sort == "title":
        return [F.col("title_group"), F.length("title_number"), F.col("title_number"), F.col("title_norm"), F.col("id")]
    in_title = reduce(lambda a, b: a & b, (tx.has_word_starting(F.col("title_norm"), w) for w in query or []), F.lit(True))
    return [F.when(in_title, 0).otherwise(1), F.desc_nulls_last(issued), F.col("id")]


def matching(rows: DataFrame, where: dict[str, Column]) -> DataFrame:
    return rows.where(reduce(lambda a, b: a & b, where.values(), F.lit(True)))


def facets(rows: DataFrame, where: dict[str, Column]) -> DataFrame:
    """Counts of each option under every condition but its own."""
    columns = {"catalogue": F.col("source"), "final_class": F.col("final_class"), "frontend_group": F.col("frontend_group"), "access": F.col("access"), "published": F.col("year"), "mappable": F.col("mappable")}
    return facet_counts(rows, where, columns)
