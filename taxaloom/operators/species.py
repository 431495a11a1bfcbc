"""From occurrence records to the tables that are served: quality filter, key merge, hexagons, cards, images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.functions.licence import licence_rank, may_be_shown
from taxaloom.operators import grid
from taxaloom.operators.relational import ordinal, rewrite_key, top_per_key

CELLS = ["h3_r4", "h3_r5", "h3_r6", "h3_r7"]
RANKS = ["kingdom", "phylum", "class", "order", "family", "genus"]
#: Flags that take a record out, and kinds of record that are left out.
BAD_FLAGS = [
    "COORDINATE_REPROJECTION_FAILED",
    "COORDINATE_REPROJECTION_SUSPICIOUS",
    "COORDINATE_UNCERTAINTY_METERS_INVALID",
    "PRESUMED_NEGATED_LATITUDE",
    "PRESUMED_NEGATED_LONGITUDE",
    "PRESUMED_SWAPPED_COORDINATE",
    "FOOTPRINT_WKT_MISMATCH",
    "FOOTPRINT_WKT_INVALID",
    "COUNTRY_COORDINATE_MISMATCH",
    "COORDINATE_PRECISION_INVALID",
    "CONTINENT_COUNTRY_MISMATCH",
    "CONTINENT_COORDINATE_MISMATCH",
]
LEFT_OUT = ["FOSSIL_SPECIMEN", "LIVING_SPECIMEN"]
TOP_DATASETS = 5


def quality_conditions(flags: list[str] | None = None) -> dict[str, Column]:
    """What a record must meet, in the order in which a removal is put down to one of them; no flags means none are set."""
    none = F.array().cast("array<string>")
    return {
        "not present": F.col("occurrencestatus") == "PRESENT",
        "kind of record": ~F.col("basisofrecord").isin(LEFT_OUT),
        "no species": F.col("species").isNotNull(),
        "no latitude": F.col("decimallatitude").isNotNull(),
        "no longitude": F.col("decimallongitude").isNotNull(),
        "flagged": ~F.coalesce(F.arrays_overlap(F.coalesce("issue", none), F.array(*map(F.lit, flags or BAD_FLAGS))), F.lit(False)),
    }


def with_cells(df: DataFrame, lat: str = "decimallatitude", lon: str = "decimallongitude") -> DataFrame:
    """A cell at each resolution, each from the coordinates: cells do not nest."""
    return grid.with_cells(df, lat, lon, {r: f"h3_r{r}" for r in grid.AREAS})


def species_hex(records: DataFrame) -> DataFrame:
    """Records by species, year and the cells of all resolutions; null keys and years are groups."""
    return records.groupBy("specieskey", "year", *CELLS).agg(F.count("*").alias("occurrences"))


def write_species_hex(table: DataFrame, path: str) -> None:
    """Sorted by species and year, so that row groups and files cover few species."""
    table.repartitionByRange("specieskey", "year").sortWithinPartitions("specieskey", "year", *CELLS).write.mode("overwrite").option("compression", "zstd").parquet(path)


def hex_table(table: DataFrame, res: int) -> DataFrame:
    """Records and distinct species of each cell; a null species counts as records alone."""
    cell = f"h3_r{res}"
    return table.where(F.col(cell).isNotNull()).groupBy(F.col(cell).alias("cell")).agg(F.sum("occurrences").alias("records"), F.countDistinct("specieskey").cast("int").alias("distinct_species"))


def hex_summary(cells: DataFrame) -> DataFrame:
    return cells.agg(
        F.count("*").alias("cells"), F.min("records").alias("least"), F.percentile("records", F.lit(0.5)).alias("median"), F.max("records").alias("most"), F.count_if(F.col("records") == 1).alias("singletons")
    )


def in_years(first: int | None, last: int | None) -> Column:
    """Whether a dated record lies in the range; everything without a range."""
    if first is None and last is None:
        return F.lit(True)
    return F.coalesce(F.col("year").between(first if first is not None else -(10**6), last if last is not None else 10**6), F.lit(False))


def left_out(table: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """total = shown + without a year + outside the range."""
    ranged = first is not None or last is not None
    no_year = F.col("year").isNull() & F.lit(ranged)
    shown = in_years(first, last)
    some = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("occurrences"))), F.lit(0)).alias
    return table.agg(some(F.lit(True))("total"), some(shown)("records_shown"), some(no_year)("no_year"), some(~shown & ~no_year)("outside"))


def overview(table: DataFrame, res: int, first: int | None = None, last: int | None = None) -> DataFrame:
    return hex_table(table.where(in_years(first, last)), res)


def species_map(table: DataFrame, key: str, res: int, first: int | None = None, last: int | None = None) -> DataFrame:
    cell = f"h3_r{res}"
    rows = table.where((F.col("specieskey") == key) & in_years(first, last) & F.col(cell).isNotNull())
    return rows.groupBy(F.col(cell).alias("cell")).agg(F.sum("occurrences").alias("records"))


def species_in_cells(table: DataFrame, cells: DataFrame | list[str], res: int, first: int | None = None, last: int | None = None, hidden: list[str] | None = None) -> DataFrame:
    """Records of each species in the cells; hidden species are gone before anything is counted, records without a species stay."""
    column = f"h3_r{res}"
    rows = table.where(in_years(first, last))
    if hidden:
        rows = rows.where(~F.coalesce("specieskey", F.lit("")).isin(hidden))
    if isinstance(cells, list):
        rows = rows.where(F.col(column).isin(cells))
    else:
        rows = rows.join(cells.select(F.col("cell").alias(column)).distinct(), column, "left_semi")
    return rows.groupBy("specieskey").agg(F.sum("occurrences").alias("records"))


def records_by_year(table: DataFrame) -> DataFrame:
    return table.groupBy("year").agg(F.sum("occurrences").alias("records"))


def taxonomy(records: DataFrame, ranks: list[str] | None = None) -> DataFrame:
    """The path of each species: one on the key's own records first, then the most common, then the first by name."""
    path = [*(ranks or RANKS), "species"]
    own = F.max((F.col("original_specieskey") == F.col("specieskey")).cast("int"))
    paths = records.where("specieskey is not null").groupBy("specieskey", *path).agg(own.alias("__own"), F.count("*").alias("__n"))
    best = top_per_key(paths, ["specieskey"], [F.desc("__own"), F.desc("__n"), *(F.asc_nulls_last(c) for c in path)])
    return best.drop("__own", "__n")


def card_stats(records: DataFrame) -> DataFrame:
    """Counts, years, datasets, extent and merged keys (null if none) of each species."""
    own = F.col("original_specieskey") == F.col("specieskey")
    merged = F.array_sort(F.collect_set(F.when(~own, F.col("original_specieskey"))))
    out = records.where("specieskey is not null").groupBy("specieskey").agg(
        F.count("*").alias("record_count"), F.count_if(F.col("year").isNull()).alias("records_no_year"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.countDistinct("datasetkey").cast("int").alias("n_datasets"),
        *(f(c).alias(f"{n}_{s}") for c, s in (("decimallatitude", "lat"), ("decimallongitude", "lon")) for n, f in (("min", F.min), ("max", F.max))),
        merged.alias("merged_keys"), F.count_if(~own).alias("merged_record_count"),
    )
    return out.withColumn("merged_keys", F.when(F.size("merged_keys") > 0, F.col("merged_keys")))


def top_datasets(records: DataFrame, datasets: DataFrame, n: int = TOP_DATASETS) -> DataFrame:
    """The n datasets with most records of each species, as an ordered list of structs."""
    counts = records.where("specieskey is not null").groupBy("specieskey", "datasetkey").agg(F.count("*").alias("records"))
    best = top_per_key(counts, ["specieskey"], [F.desc("records"), F.asc_nulls_last("datasetkey")], n).join(datasets.select("datasetkey", "title"), "datasetkey", "left")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("records")).alias("o"), "datasetkey", "title", "records")))
    return best.groupBy("specieskey").agg(F.transform(listed, lambda x: F.struct(x["datasetkey"].alias("datasetkey"), x["title"].alias("title"), x["records"].alias("records"))).alias("top_datasets"))


def merged_names(merge: DataFrame, names: DataFrame) -> DataFrame:
    """Names of merged keys that differ from the kept key's own, null if none."""
    old = names.select(F.col("id").alias("old_key"), F.col("scientific_name").alias("name"), F.coalesce("authorship", F.lit("")).alias("authorship"))
    kept = names.select(F.col("id").alias("kept_key"), F.col("scientific_name").alias("kept_name"))
    rows = merge.join(old, "old_key").join(kept, "kept_key", "left").where(~F.col("name").eqNullSafe(F.col("kept_name")))
    return rows.groupBy(F.col("kept_key").alias("specieskey")).agg(F.array_sort(F.collect_list(F.struct(F.col("old_key").alias("key"), "name", "authorship"))).alias("merged_names"))


def species_card(records: DataFrame, datasets: DataFrame, merge: DataFrame, names: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """One row for each species; records already have the kept key and original_specieskey."""
    own = names.select(F.col("id").alias("specieskey"), F.col("scientific_name").alias("col_name"), F.coalesce("authorship", F.lit("")).alias("col_authorship"))
    out = card_stats(records).join(taxonomy(records), "specieskey", "left").join(top_datasets(records, datasets), "specieskey", "left").join(merged_names(merge, names), "specieskey", "left").join(own, "specieskey", "left")
    out = out.withColumn("name_source", F.when(F.col("col_name").isNotNull(), "checklist").otherwise("species name, not in the checklist"))
    out = out.withColumns({"col_name": F.coalesce("col_name", "species"), "col_authorship": F.coalesce("col_authorship", F.lit(""))})
    return out if images is None else out.join(images, "specieskey", "left")


def apply_merge(records: DataFrame, merge: DataFrame) -> DataFrame:
    return rewrite_key(records, merge, "specieskey", "original_specieskey")


def merge_summary(records: DataFrame) -> DataFrame:
    """Of records with kept keys: keys merged, keys that others were merged into, records moved."""
    moved = records.where(F.col("original_specieskey") != F.col("specieskey"))
    return moved.agg(F.countDistinct("original_specieskey").alias("old_keys"), F.countDistinct("specieskey").alias("kept_keys"), F.count("*").alias("records"))


def merge_candidates(names: DataFrame, levels: list[str]) -> DataFrame:
    """Names with exactly two keys: whether one taxon may be meant (equal where both are set, at most one level empty on one side, never genus or species)."""
    two = names.groupBy("species").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(F.col("specieskey"), F.col("records"), F.col("accepted"), *levels))).alias("k")).where("n = 2")
    a, b = F.col("k")[0], F.col("k")[1]
    conflict = F.filter(F.array(*(F.when(a[c].isNotNull() & b[c].isNotNull() & (a[c] != b[c]), F.lit(c)) for c in levels)), lambda x: x.isNotNull())
    empty = F.filter(F.array(*(F.when(a[c].isNull() != b[c].isNull(), F.lit(c)) for c in levels)), lambda x: x.isNotNull())
    ok = (F.size(conflict) == 0) & (F.size(empty) <= 1) & ~F.arrays_overlap(empty, F.array(F.lit("genus"), F.lit("species")))
    order = lambda x: F.struct((~x["accepted"]).alias("a"), (-x["records"]).alias("r"), x["specieskey"].alias("k"))
    first = order(a) <= order(b)
    kept, old = F.when(first, a["specieskey"]).otherwise(b["specieskey"]), F.when(first, b["specieskey"]).otherwise(a["specieskey"])
    return two.select("species", old.alias("old_key"), kept.alias("kept_key"), ok.alias("merge"), F.array_join(conflict, ",").alias("conflicts"), F.array_join(empty, ",").alias("empty_levels"))


def rank_index(cards: DataFrame, ranks: list[str] | None = None) -> DataFrame:
    """Every taxon: each prefix of each path whose last rank is set, with its species and records. No ROLLUP: its nulls would meet missing ranks."""
    ranks = ranks or RANKS
    parts = []
    for i, rank in enumerate(ranks):
        path = ranks[: i + 1]
        part = cards.where(F.col(rank).isNotNull()).groupBy(*path).agg(F.count("*").alias("species"), F.sum("record_count").alias("records"))
        parts.append(part.select(F.lit(rank).alias("rank"), F.col(rank).alias("name"), *(F.col(r) if r in path else F.lit(None).cast("string").alias(r) for r in ranks), "species", "records"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rank_hits(index: DataFrame, norm: str, n: int) -> DataFrame:
    """The n best taxa of an index whose search form holds norm, with a tier: 0 the same, 1 at the start of a word, 2 within one."""
    tier = F.when(F.col("norm") == norm, 0).when(F.contains(F.concat(F.lit(" "), "norm"), F.lit(" " + norm)), 1).otherwise(2)
    depth = F.array_position(F.array(*map(F.lit, RANKS)), F.col("rank"))
    return index.where(F.contains("norm", F.lit(norm))).withColumn("tier", tier).orderBy("tier", F.desc("records"), depth, "name", *RANKS).limit(n)


def _above(rank: Column) -> Column:
    """Names of the ranks above a taxon's own, nearest first; '' where one is missing."""
    depth = F.array_position(F.array(*map(F.lit, RANKS)), rank).cast("int")
    return F.reverse(F.slice(F.array(*(F.coalesce(F.col(r), F.lit("")) for r in RANKS)), F.lit(1), depth - 1))


def labelled(hits: DataFrame, index: DataFrame) -> DataFrame:
    """hits with a label: rank, name and in brackets what tells it from all taxa of that rank and name.

    That is the nearest named parent, or where others share it, as many parents from the nearest upward
    as no other has alike, missing ones written "no <rank>". The kingdom has none.
    """
    named = lambda x: F.get(F.filter(x, lambda name: name != ""), 0)
    mine = hits.withColumn("above", _above(F.col("rank")))
    others = mine.select("rank", "name").distinct().join(index.select("rank", "name", _above(F.col("rank")).alias("above")), ["rank", "name"]).groupBy("rank", "name").agg(F.collect_list("above").alias("others"))
    rows = mine.join(others, ["rank", "name"], "left").withColumn("others", F.filter(F.coalesce("others", F.array().cast("array<array<string>>")), lambda x: x != F.col("above")))
    counts = F.sequence(F.lit(1), F.greatest(F.size("above"), F.lit(1)))
    apart = lambda k: ~F.exists("others", lambda x: F.slice(x, F.lit(1), k) == F.slice("above", F.lit(1), k)) & named(F.slice("above", F.lit(1), k)).isNotNull()
    enough = F.coalesce(F.get(F.filter(counts, apart), 0), F.size("above"))
    ranks_above = F.reverse(F.slice(F.array(*map(F.lit, RANKS)), F.lit(1), F.size("above")))
    written = F.transform(F.slice("above", F.lit(1), enough), lambda x, i: F.when(x != "", x).otherwise(F.concat(F.lit("no "), F.get(ranks_above, i))))
    alone = ~F.exists("others", lambda x: named(x).eqNullSafe(named(F.col("above"))))
    words = F.when(named(F.col("above")).isNull(), F.lit("")).when(alone, F.concat(F.lit(" ("), named(F.col("above")), F.lit(")"))).otherwise(F.concat(F.lit(" ("), F.array_join(written, ", "), F.lit(")")))
    return rows.withColumn("label", F.concat(F.initcap("rank"), F.lit(" "), "name", words)).drop("above", "others")


def path_is(path: dict[str, str | None]) -> Column:
    """A taxon is its whole path; missing ranks are compared null-safely."""
    out = F.lit(True)
    for rank, name in path.items():
        out = out & F.col(rank).eqNullSafe(F.lit(name))
    return out


def rank_children(members: DataFrame, child: str) -> DataFrame:
    """Species and records by the next rank; a missing name last among equals."""
    return members.groupBy(F.col(child).alias("name")).agg(F.count("*").alias("species"), F.sum("records").alias("records"))


def media_order(media: DataFrame) -> DataFrame:
    """Numbers a record's media by their place in the file."""
    return ordinal(media, ["gbifid"], [F.col("file_row")], "media_order")


def species_images(records: DataFrame, media: DataFrame) -> DataFrame:
    """The image to show for each species: best licence, then the newest record, the smallest id, the first image."""
    fit = media.where((F.col("type") == "StillImage") & may_be_shown(F.col("identifier"), F.col("references"), F.coalesce(F.nullif(F.btrim("creator"), F.lit("")), F.col("rightsholder")), F.col("license_code")))
    rows = fit.withColumn("license_rank", licence_rank(F.col("license_code"))).join(records.select("gbifid", "specieskey", "eventdate"), "gbifid").where("specieskey is not null")
    order = [F.asc_nulls_last("license_rank"), F.desc_nulls_last("eventdate"), F.col("gbifid").cast("bigint"), F.col("media_order")]
    return top_per_key(rows, ["specieskey"], order)


def publisher_of(datasets: DataFrame) -> DataFrame:
    """The publisher named most for each dataset."""
    counts = datasets.groupBy("datasetkey", "publisher").agg(F.count("*").alias("n"))
    return top_per_key(counts, ["datasetkey"], [F.desc("n"), F.asc_nulls_last("publisher")]).drop("n")


def count_with_total(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """n rows in order, each with the number of all rows."""
    return df.orderBy(*order).limit(n).withColumn("total", F.lit(df.count()).cast("bigint"))


def running_total(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(value).over(w))
