"""The query surface: each question of the map and its lists as a method. Results are DataFrames, or dicts of DataFrames and numbers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.functions import text as tx
from taxaloom.functions.geo import polygon_area_km2
from taxaloom.operators import catalogue as cat
from taxaloom.operators import checks, grid, species
from taxaloom.plans import area, datasets, schemas
from taxaloom.sources.sinks import described_csv

STATUS_OPTIONS = ["red", "blue", "yellow", "exotic", "none"]
SORTS = ["most_records", "fewest_records", "scientific", "english"]
MAX_AREA_CELLS = 200_000


class BadRequest(ValueError):
    """A request that cannot be answered as it is."""


class Unknown(KeyError):
    """Something that is asked for by name and is not there."""


class Atlas:
    """Served tables by name. Small derived tables are computed once; the records stay on disk."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], hidden: list[str] | None = None):
        lacking = checks.missing_columns({n: df for n, df in tables.items()}, {"species_hex": ["specieskey", "year", *species.CELLS, "occurrences"], "species_card": ["specieskey", "col_name", "record_count", *schemas.RANKS]})
        if lacking:
            raise BadRequest("missing: " + ", ".join(lacking))
        self.spark, self.tables, self.hidden = spark, tables, hidden or []

    @classmethod
    def open(cls, spark: SparkSession, root: str, hidden: list[str] | None = None) -> Atlas:
        return cls(spark, {name: spark.read.parquet(f"{root}/{name}") for name in schemas.TABLES}, hidden)

    # derived

    @property
    def hexes(self) -> DataFrame:
        return self.tables["species_hex"]

    @property
    def cards(self) -> DataFrame:
        return self.tables["species_card"]

    def shown(self, rows: DataFrame) -> DataFrame:
        """Rows of species that may be shown; rows without a species stay."""
        return rows.where(~F.coalesce("specieskey", F.lit("")).isin(self.hidden)) if self.hidden else rows

    @cached_property
    def names(self) -> DataFrame:
        return cat.search_names(self.cards, self.tables.get("bcsee_status")).cache()

    @cached_property
    def species_year(self) -> DataFrame:
        return self.hexes.where("specieskey is not null").groupBy("specieskey", "year").agg(F.sum("occurrences").alias("records")).cache()

    @cached_property
    def ranks(self) -> DataFrame:
        """Every taxon with what it holds of shown species."""
        return species.rank_index(self.shown(self.cards)).withColumn("norm", tx.search_norm(F.col("name"))).cache()

    @cached_property
    def catalogue(self) -> DataFrame:
        return datasets.search_columns(self.tables["datasets"], self.tables.get("dataset_source_checks")).cache()

    @cached_property
    def details(self) -> DataFrame:
        """What lists show of a species."""
        own = self.cards.select("specieskey", "col_name")
        status = self.tables.get("bcsee_status")
        if status is None:
            return own.withColumns({"english_name": F.lit(None).cast("string"), "statuses": F.array().cast("array<string>")})
        english = F.get(F.transform(F.filter("entries", lambda e: e["is_species_level"]), lambda e: e["common_label"]), F.lit(0))
        return own.join(status.select(F.col("gbif_species_key").alias("specieskey"), F.nullif(F.btrim(english), F.lit("")).alias("english_name"), "statuses"), "specieskey", "left").cache()

    # validation

    def year_range(self, first: int | None, last: int | None) -> tuple[int | None, int | None]:
        """Open ends filled from the data; an empty range is refused."""
        if first is None and last is None:
            return None, None
        low, high = self.hexes.agg(F.min("year"), F.max("year")).first()
        first, last = first if first is not None else low, last if last is not None else high
        if first is not None and last is not None and first > last:
            raise BadRequest(f"the years {first} to {last} are no range")
        return first, last

    @staticmethod
    def resolution(res: int) -> int:
        if res not in grid.AREAS:
            raise BadRequest(f"resolution {res} is none of {', '.join(map(str, grid.AREAS))}")
        return res

    def resolve(self, key: str) -> tuple[str, str | None]:
        """The kept key of a key, and the key asked for if it was merged."""
        row = self.cards.where((F.col("specieskey") == key) | F.array_contains(F.coalesce("merged_keys", F.array().cast("array<string>")), key)).select("specieskey").first()
        if row is None or row.specieskey in self.hidden:
            raise Unknown(key)
        return row.specieskey, key if key != row.specieskey else None

    # numbers, cards, maps

    def meta(self) -> DataFrame:
        return self.hexes.agg(F.sum("occurrences").alias("records"), F.countDistinct("specieskey").alias("species"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.coalesce(F.sum(F.when(F.col("year").isNull(), F.col("occurrences"))), F.lit(0)).alias("no_year"))

    def species_card(self, key: str) -> dict:
        kept, merged_from = self.resolve(key)
        return {"merged_from": merged_from, "card": self.cards.where(F.col("specieskey") == kept), "status": self.tables["bcsee_status"].where(F.col("gbif_species_key") == kept) if "bcsee_status" in self.tables else None}

    def species_hexes(self, key: str, res: int, first: int | None = None, last: int | None = None) -> dict:
        kept, merged_from = self.resolve(key)
        a, b = self.year_range(first, last)
        own = self.hexes.where(F.col("specieskey") == kept)
        return {"merged_from": merged_from, "cells": species.species_map(self.hexes, kept, self.resolution(res), a, b), "left_out": species.left_out(own, a, b)}

    def overview_hexes(self, res: int, first: int | None = None, last: int | None = None) -> dict:
        a, b = self.year_range(first, last)
        return {"cells": species.overview(self.hexes, self.resolution(res), a, b), "left_out": species.left_out(self.hexes, a, b)}

    # species lists

    def _list(self, counted: DataFrame, q: str | None, statuses: list[str] | None, sort: str, page: int, size: int | None) -> dict:
        """One page of a species list, and its counts by status: under the name filter, whatever the status filter."""
        if sort not in SORTS:
            raise BadRequest(f"sort must be one of {', '.join(SORTS)}")
        asked = [s.strip().lower() for s in statuses or [] if s.strip()]
        if unknown := sorted(set(asked) - set(STATUS_OPTIONS)):
            raise BadRequest(f"no status {', '.join(unknown)}")
        rows = counted.where("specieskey is not null").join(self.details, "specieskey", "left")
        none = F.array(F.lit("none"))
        rows = rows.withColumn("options", F.when(F.size(F.coalesce("statuses", F.array().cast("array<string>"))) > 0, F.transform("statuses", lambda s: F.lower(s))).otherwise(none))
        if q:
            norm = tx.search_form(q)
            if len(norm.replace(" ", "")) < 2:
                raise BadRequest("a name filter needs at least two letters or digits")
            rows = rows.join(self.names.where(F.contains("norm", F.lit(norm))).select("specieskey").distinct(), "specieskey", "left_semi")
        counts = rows.select(F.explode("options").alias("status")).groupBy("status").agg(F.count("*").alias("species"))
        shown = rows.where(F.arrays_overlap("options", F.array(*map(F.lit, asked)))) if asked else rows
        name = F.lower(F.coalesce("col_name", F.lit("")))
        orders = {
            "most_records": [F.desc("records"), name], "fewest_records": [F.col("records"), name], "scientific": [name],
            "english": [F.col("english_name").isNull(), F.lower(F.coalesce("english_name", F.lit(""))), name],
        }
        results = shown.orderBy(*orders[sort], "specieskey").drop("options")
        if size is not None:
            results = results.offset((page - 1) * size).limit(size)
        return {"status_counts": counts, "matching": shown.agg(F.count("*").alias("matching")), "results": results}

    def cell_species(self, cell: str, first: int | None = None, last: int | None = None, q: str | None = None, statuses: list[str] | None = None, sort: str = "most_records", page: int = 1, size: int | None = 50, rank: dict[str, str | None] | None = None) -> dict:
        try:
            res = grid.resolution(cell)
        except ValueError as e:
            raise BadRequest(str(e)) from e
        a, b = self.year_range(first, last)
        rows = self.shown(self._of_rank(self.hexes, rank))
        counted = species.species_in_cells(rows, [cell], res, a, b)
        return self._list(counted, q, statuses, sort, page, size) | {"left_out": species.left_out(rows.where(F.col(f"h3_r{res}") == cell), a, b), "by_year": species.records_by_year(rows.where(F.col(f"h3_r{res}") == cell))}

    def area_species(self, text: str, res: int, first: int | None = None, last: int | None = None, q: str | None = None, statuses: list[str] | None = None, sort: str = "most_records", page: int = 1, size: int | None = 50) -> dict:
        try:
            rings = area.read(text)
            if sum(polygon_area_km2(r) for r in rings) > MAX_AREA_CELLS * grid.AREAS[self.resolution(res)]:
                raise BadRequest("the area is too large for this resolution")
            cells = set().union(*(grid.cover(r, res, MAX_AREA_CELLS) for r in rings))
        except area.AreaError as e:
            raise BadRequest(str(e)) from e
        a, b = self.year_range(first, last)
        frame = self.spark.createDataFrame([(c,) for c in sorted(cells)], "cell string")
        counted = species.species_in_cells(self.hexes, frame, res, a, b, self.hidden)
        return self._list(counted, q, statuses, sort, page, size) | {"cells": len(cells)}

    # ranks

    def _of_rank(self, rows: DataFrame, path: dict[str, str | None] | None) -> DataFrame:
        if not path:
            return rows
        members = self.shown(self.cards).where(species.path_is(path))
        if members.isEmpty():
            raise Unknown(str(path))
        return rows.join(members.select("specieskey"), "specieskey", "left_semi")

    def rank_hexes(self, path: dict[str, str | None], res: int, first: int | None = None, last: int | None = None) -> dict:
        a, b = self.year_range(first, last)
        own = self._of_rank(self.hexes, path)
        return {"cells": species.overview(own, self.resolution(res), a, b), "left_out": species.left_out(own, a, b)}

    def rank_card(self, path: dict[str, str | None], first: int | None = None, last: int | None = None, **options) -> dict:
        a, b = self.year_range(first, last)
        years = self._of_rank(self.species_year, path).where(species.in_years(a, b))
        counted = years.groupBy("specieskey").agg(F.sum("records").alias("records"))
        deeper = schemas.RANKS.index(list(path)[-1]) + 1
        members = counted.join(self.cards.select("specieskey", *schemas.RANKS), "specieskey")
        children = species.rank_children(members, schemas.RANKS[deeper]) if deeper < len(schemas.RANKS) else None
        undated = self._of_rank(self.species_year, path).where("year is null").agg(F.coalesce(F.sum("records"), F.lit(0)).alias("no_year"))
        return self._list(counted, options.get("q"), options.get("statuses"), options.get("sort", "most_records"), options.get("page", 1), options.get("size", 50)) | {"children": children, "undated": undated}

    # search

    def search(self, q: str, limit: int = 20, rank_limit: int = 5) -> dict:
        """Species by name, and taxa of higher rank whose names begin with the query, told apart by their nearest named parents."""
        if not 0 < limit <= 50 or not 0 < rank_limit <= 20:
            raise BadRequest("limits are 1 to 50 and 1 to 20")
        norm = tx.search_form(q)
        if len(norm.replace(" ", "")) < 2:
            raise BadRequest("a search needs at least two letters or digits")
        return {"species": cat.tiered_search(self.names, self.cards, q, limit, self.hidden), "ranks": species.labelled(species.rank_hits(self.ranks, norm, rank_limit), self.ranks)}

    # datasets

    def list_datasets(self, q: str | None = None, sort: str = "relevance", page: int = 1, size: int | None = 20, species_key: str | None = None, **filters) -> dict:
        if sort not in datasets.SORTS:
            raise BadRequest(f"sort must be one of {', '.join(datasets.SORTS)}")
        norm = tx.search_form(q) if q and q.strip() else ""
        if q and q.strip() and len(norm.replace(" ", "")) < 2:
            raise BadRequest("a search needs at least two letters or digits")
        asked = datasets.words(norm)
        where = datasets.conditions(asked, **filters)
        rows = self.catalogue
        if species_key:
            kept, _ = self.resolve(species_key)
            rows = rows.join(self.tables["dataset_species_links"].where(F.col("specieskey") == kept).select(F.col("dataset_id").alias("id")).distinct(), "id", "left_semi")
        found = datasets.matching(rows, where)
        results = found.orderBy(*datasets.order(sort, asked)).drop("title_norm", "title_group", "title_number", "text_norm").withColumn("abstract", tx.preview(F.col("abstract")))
        if size is not None:
            results = results.offset((page - 1) * size).limit(size)
        return {"total": found.agg(F.count("*").alias("total")), "results": results, "facets": datasets.facets(rows, where)}

    def get_dataset(self, key: str) -> dict:
        """A dataset by its own id or that of one of its copies, and the species its organism names link to."""
        copies = F.coalesce("other_copies", F.array().cast(dict(self.tables["datasets"].dtypes)["other_copies"]))
        row = self.catalogue.where((F.col("id") == key) | F.exists(copies, lambda c: c["id"] == key))
        first = row.select("id").first()
        if first is None:
            raise Unknown(key)
        links = self.tables["dataset_species_links"].where(F.col("dataset_id") == first.id).orderBy("position")
        return {"copy_of": first.id if first.id != key else None, "dataset": row, "links": links.join(self.cards.select("specieskey", "col_name"), "specieskey", "left")}

    # exports: the same lists without pages

    def _export(self, results: DataFrame, order: list[str], title: str, notes: list[str]) -> Iterator[str]:
        total = self.meta().first()
        flat = results.select(*(F.array_join(F.col(c).cast("array<string>"), "; ").alias(c) if t.startswith("array<string") else F.col(c) for c, t in results.dtypes if "struct" not in t))
        return described_csv(flat, order, [title, *notes, f"records in all: {total.records}", f"years: {total.first_year} to {total.last_year}"])

    def export_datasets(self, q: str | None = None, **filters) -> Iterator[str]:
        return self._export(self.list_datasets(q, size=None, **filters)["results"], ["id"], "datasets", [f"search: {q or 'none'}"])

    def export_rank(self, path: dict[str, str | None], **options) -> Iterator[str]:
        return self._export(self.rank_card(path, size=None, **options)["results"], ["specieskey"], "species of a taxon", [str(path)])

    def export_hexagon(self, cell: str, **options) -> Iterator[str]:
        return self._export(self.cell_species(cell, size=None, **options)["results"], ["specieskey"], "species of a hexagon", [f"{cell} {grid.outline_wkt(cell)}"])

    def export_area(self, text: str, res: int, **options) -> Iterator[str]:
        return self._export(self.area_species(text, res, size=None, **options)["results"], ["specieskey"], "species of an area", [text])
