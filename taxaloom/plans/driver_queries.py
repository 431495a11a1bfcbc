"""A query over the driver's tables for each operator, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import dates, geo, licence, links
from taxaloom.functions import text as tx
from taxaloom.operators import catalogue as cat
from taxaloom.operators import authors, checks, evaluation, grid, places, polygons, species, statuses
from taxaloom.operators import relational as rel
from taxaloom.plans import datasets
from taxaloom.plans.atlas import Atlas
from taxaloom.plans.driver_base import DUCK_NORM, Roles, sql

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None, *parts: str):
    def add(f: Callable[[Roles], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Roles(spark, sf_dir))
        if oracle is not None:
            ORACLE_SQL[f.__name__] = sql(oracle, *parts)
        return f

    return add


HEXES = "SELECT h3_r{0} AS cell, CAST(sum(occurrences) AS BIGINT) AS records, CAST(count(DISTINCT specieskey) AS INTEGER) AS distinct_species FROM hex WHERE h3_r{0} IS NOT NULL {1} GROUP BY 1"


@query(HEXES.format(6, ""), "hex")
def overview_hexes(r):
    return species.overview(r.hex, 6)


@query(HEXES.format(4, "AND year BETWEEN 1997 AND 1999"), "hex")
def overview_hexes_years(r):
    return species.overview(r.hex, 4, 1997, 1999)


@query(
    "SELECT CAST(sum(occurrences) AS BIGINT) AS total, CAST(coalesce(sum(occurrences) FILTER (WHERE year BETWEEN 1997 AND 1999), 0) AS BIGINT) AS records_shown, CAST(coalesce(sum(occurrences) FILTER (WHERE year IS NULL), 0) AS BIGINT) AS no_year, CAST(coalesce(sum(occurrences) FILTER (WHERE year NOT BETWEEN 1997 AND 1999), 0) AS BIGINT) AS outside FROM hex",
    "hex",
)
def records_left_out(r):
    return species.left_out(r.hex, 1997, 1999)


@query("SELECT specieskey, year, h3_r4, h3_r5, h3_r6, h3_r7, occurrences FROM hex", "hex")
def species_hex_build(r):
    return r.built_hex


@query("SELECT h3_r5 AS cell, CAST(sum(occurrences) AS BIGINT) AS records FROM hex WHERE specieskey = 'K50' AND h3_r5 IS NOT NULL GROUP BY 1", "hex")
def species_map(r):
    return species.species_map(r.hex, "K50", 5)


@query(
    f"SELECT count(*) AS cells, min(records) AS least, CAST(quantile_cont(records, 0.5) AS DOUBLE) AS median, max(records) AS most, count(*) FILTER (WHERE records = 1) AS singletons FROM ({HEXES.format(5, '')})",
    "hex",
)
def hex_summary_stats(r):
    return species.hex_summary(species.hex_table(r.hex, 5))


@query(
    """SELECT specieskey, count(*) AS record_count, count(*) FILTER (WHERE year IS NULL) AS records_no_year, min(year) AS first_year, max(year) AS last_year, CAST(count(DISTINCT datasetkey) AS INTEGER) AS n_datasets,
    min(decimallatitude) AS min_lat, max(decimallatitude) AS max_lat, min(decimallongitude) AS min_lon, max(decimallongitude) AS max_lon,
    string_agg(DISTINCT original_specieskey, ',' ORDER BY original_specieskey) FILTER (WHERE original_specieskey <> specieskey) AS merged_keys, count(*) FILTER (WHERE original_specieskey <> specieskey) AS merged_record_count
    FROM keyed WHERE specieskey IS NOT NULL GROUP BY specieskey""",
    "keyed",
)
def species_card_stats(r):
    return species.card_stats(r.keyed).withColumn("merged_keys", F.array_join("merged_keys", ","))


@query(
    """SELECT specieskey, datasetkey, s_name AS title, records, CAST(place AS INTEGER) AS place FROM (SELECT specieskey, datasetkey, count(*) AS records, row_number() OVER (PARTITION BY specieskey ORDER BY count(*) DESC, datasetkey) AS place FROM keyed WHERE specieskey IS NOT NULL GROUP BY 1, 2)
    LEFT JOIN supplier ON datasetkey = 'D' || s_suppkey WHERE place <= 5""",
    "keyed",
)
def card_top_datasets(r):
    named = r.table("supplier").select(F.concat(F.lit("D"), F.col("s_suppkey").cast("string")).alias("datasetkey"), F.col("s_name").alias("title"))
    out = species.top_datasets(r.keyed, named)
    return out.select("specieskey", F.posexplode("top_datasets").alias("p", "d")).select("specieskey", "d.datasetkey", "d.title", "d.records", (F.col("p") + 1).cast("int").alias("place"))


@query(
    """SELECT specieskey, kingdom, phylum, class_ AS class, order_ AS "order", family, genus, species FROM (SELECT specieskey, kingdom, phylum, class_, order_, family, genus, species, row_number() OVER (PARTITION BY specieskey ORDER BY max(CASE WHEN original_specieskey = specieskey THEN 1 ELSE 0 END) DESC, count(*) DESC, kingdom NULLS LAST, phylum NULLS LAST, class_ NULLS LAST, order_ NULLS LAST, family NULLS LAST, genus NULLS LAST, species NULLS LAST) AS rn
    FROM keyed WHERE specieskey IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) WHERE rn = 1""",
    "keyed",
)
def card_taxonomy_argmax(r):
    return species.taxonomy(r.keyed)


@query("SELECT kingdom, phylum, class_ AS class, order_ AS \"order\", family, genus, species, count(*) AS records FROM occ GROUP BY ALL", "occ")
def species_summary(r):
    return r.occ.groupBy(*species.RANKS, "species").agg(F.count("*").alias("records"))


@query("SELECT p_name AS name, count(DISTINCT p_brand) AS keys, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS found FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def names_with_several_keys(r):
    out = r.table("part").groupBy(F.col("p_name").alias("name")).agg(F.countDistinct("p_brand").alias("keys"), F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("found"))
    return out.where("keys > 1")


@query("SELECT gbifid, original_specieskey, specieskey FROM keyed", "keyed")
def key_merge_rewrite(r):
    return r.keyed.select("gbifid", "original_specieskey", "specieskey")


@query("SELECT count(DISTINCT original_specieskey) AS old_keys, count(DISTINCT specieskey) AS kept_keys, count(*) AS records FROM keyed WHERE original_specieskey <> specieskey", "keyed")
def merge_summary(r):
    return species.merge_summary(r.keyed)


@query("SELECT m.kept_key AS specieskey, m.old_key, p.p_name AS name FROM merge_keys m JOIN part p ON m.old_key = 'K' || p.p_partkey JOIN part k ON m.kept_key = 'K' || k.p_partkey WHERE p.p_name <> k.p_name", "merge_keys")
def merged_names(r):
    names = r.table("part").select(F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("scientific_name"), F.lit(None).cast("string").alias("authorship"))
    return species.merged_names(r.merge, names).select("specieskey", F.explode("merged_names").alias("m")).select("specieskey", F.col("m.key").alias("old_key"), "m.name")


FLAGGED = "coalesce(list_has_any(list_transform(string_split(issue_text, ';'), lambda x: trim(x)), ['COUNTRY_COORDINATE_MISMATCH']), false)"
PASSES = f"occurrencestatus = 'PRESENT' AND basisofrecord NOT IN ('FOSSIL_SPECIMEN', 'LIVING_SPECIMEN') AND species IS NOT NULL AND decimallatitude IS NOT NULL AND decimallongitude IS NOT NULL AND NOT {FLAGGED}"


def _flagged(r):
    return r.occ.withColumn("issue", tx.split_list(F.col("issue_text")))


@query(f"SELECT gbifid FROM occ WHERE {PASSES}", "occ")
def quality_filter(r):
    return rel.apply_filters(_flagged(r), species.quality_conditions()).select("gbifid")


@query(
    f"""SELECT CASE WHEN NOT coalesce(occurrencestatus = 'PRESENT', false) THEN 'not present' WHEN NOT coalesce(basisofrecord NOT IN ('FOSSIL_SPECIMEN', 'LIVING_SPECIMEN'), false) THEN 'kind of record' WHEN species IS NULL THEN 'no species' WHEN decimallatitude IS NULL THEN 'no latitude' WHEN decimallongitude IS NULL THEN 'no longitude' WHEN {FLAGGED} THEN 'flagged' ELSE 'kept' END AS reason, count(*) AS records FROM occ GROUP BY 1""",
    "occ",
)
def first_failure_report(r):
    return rel.failure_report(_flagged(r), species.quality_conditions())


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(occurrencestatus, '') <> 'PRESENT') AS absent, count(*) FILTER (WHERE basisofrecord IN ('FOSSIL_SPECIMEN', 'LIVING_SPECIMEN')) AS kind, count(*) FILTER (WHERE species IS NULL) AS species, count(*) FILTER (WHERE decimallatitude IS NULL) AS latitude, count(*) FILTER (WHERE decimallongitude IS NULL) AS longitude, count(*) FILTER (WHERE {FLAGGED}) AS flagged, count(*) FILTER (WHERE {PASSES}) AS kept FROM occ""",
    "occ",
)
def single_pass_drops(r):
    return rel.drop_report(_flagged(r), dict(zip(("absent", "kind", "species", "latitude", "longitude", "flagged"), species.quality_conditions().values(), strict=True)))


BUSY = "(SELECT h3_r4 FROM hex WHERE h3_r4 IS NOT NULL GROUP BY 1 ORDER BY sum(occurrences) DESC, h3_r4 LIMIT 3)"


def _busy(r, n=3):
    return r.hex.where("h3_r4 is not null").groupBy(F.col("h3_r4").alias("cell")).agg(F.sum("occurrences").alias("n")).orderBy(F.desc("n"), "cell").limit(n)


@query(f"SELECT specieskey, CAST(sum(occurrences) AS BIGINT) AS records FROM hex WHERE h3_r4 IN {BUSY} AND coalesce(specieskey, '') NOT IN ('K7', 'K14') GROUP BY 1", "hex")
def cell_species_list(r):
    return species.species_in_cells(r.hex, _busy(r), 4, hidden=["K7", "K14"])


@query(f"SELECT CASE WHEN CAST(substr(specieskey, 2) AS BIGINT) % 3 = 0 THEN 'red' WHEN CAST(substr(specieskey, 2) AS BIGINT) % 3 = 1 THEN 'blue' ELSE 'none' END AS status, count(DISTINCT specieskey) AS species FROM hex WHERE specieskey IS NOT NULL AND h3_r4 IN {BUSY} GROUP BY 1", "hex")
def cell_status_counts(r):
    n = F.substring("specieskey", 2, 20).cast("bigint") % 3
    listed = species.species_in_cells(r.hex, _busy(r), 4).where("specieskey is not null").withColumn("statuses", F.when(n == 0, F.array(F.lit("red"))).when(n == 1, F.array(F.lit("blue"))).otherwise(F.array().cast("array<string>")))
    options = F.when(F.size("statuses") > 0, F.col("statuses")).otherwise(F.array(F.lit("none")))
    return listed.select(F.explode(options).alias("status")).groupBy("status").agg(F.count("*").alias("species"))


@query("SELECT y.year, coalesce(n, 0) AS records FROM (SELECT CAST(unnest(generate_series((SELECT min(year) FROM hex), (SELECT max(year) FROM hex))) AS INTEGER) AS year) y LEFT JOIN (SELECT year, CAST(sum(occurrences) AS BIGINT) AS n FROM hex WHERE year % 2 = 0 GROUP BY 1) c ON c.year = y.year", "hex")
def species_year_bars(r):
    span = r.hex.agg(F.min("year").alias("a"), F.max("year").alias("b")).select(F.explode(F.array("a", "b")).alias("year"), F.lit(0).cast("bigint").alias("records"))
    even = species.records_by_year(r.hex.where("year % 2 = 0"))
    return rel.fill_years(even.unionByName(span).groupBy("year").agg(F.sum("records").alias("records")), "year", "records")


MEMBERS = "SELECT specieskey FROM card WHERE kingdom = 'PROMO' AND phylum = 'Brand#3'"


def _members(r):
    return r.card.where(species.path_is({"kingdom": "PROMO", "phylum": "Brand#3"}))


@query(f"SELECT specieskey, CAST(sum(occurrences) AS BIGINT) AS records FROM hex WHERE specieskey IN ({MEMBERS}) AND year BETWEEN 1996 AND 1999 GROUP BY 1", "hex", "card")
def rank_card(r):
    own = r.hex.join(_members(r).select("specieskey"), "specieskey", "left_semi").where(species.in_years(1996, 1999))
    return own.groupBy("specieskey").agg(F.sum("occurrences").alias("records"))


@query("SELECT class_ AS name, count(*) AS species, CAST(sum(record_count) AS BIGINT) AS records FROM card WHERE kingdom = 'PROMO' AND phylum = 'Brand#3' GROUP BY 1", "card")
def rank_children(r):
    return species.rank_children(_members(r).withColumn("records", F.col("record_count")), "class")


@query(f"SELECT h3_r4 AS cell, CAST(sum(occurrences) AS BIGINT) AS records, CAST(count(DISTINCT specieskey) AS INTEGER) AS distinct_species FROM hex WHERE specieskey IN ({MEMBERS}) AND h3_r4 IS NOT NULL GROUP BY 1", "hex", "card")
def rank_map(r):
    return species.overview(r.hex.join(_members(r).select("specieskey"), "specieskey", "left_semi"), 4)


_PATH = ["kingdom", "phylum", "class_", "order_", "family", "genus"]
_SHOWN = ["kingdom", "phylum", "class", '"order"', "family", "genus"]


@query(
    " UNION ALL ".join(
        f"SELECT '{_SHOWN[i].strip(chr(34))}' AS rank, {c} AS name, " + ", ".join(f"{p if j <= i else 'CAST(NULL AS VARCHAR)'} AS {_SHOWN[j]}" for j, p in enumerate(_PATH)) + f", count(*) AS species, CAST(sum(record_count) AS BIGINT) AS records FROM card WHERE {c} IS NOT NULL GROUP BY " + ", ".join(_PATH[: i + 1])
        for i, c in enumerate(_PATH)
    ),
    "card",
)
def rank_index(r):
    return species.rank_index(r.card)


@query(f"SELECT CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS no_year FROM hex WHERE year IS NULL AND specieskey IN ({MEMBERS})", "hex", "card")
def rank_undated(r):
    return r.hex.join(_members(r).select("specieskey"), "specieskey", "left_semi").where("year is null").agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("no_year"))


@query(f"SELECT rank, name, records, CAST(CASE WHEN {DUCK_NORM.format('name')} = 'brand 1' THEN 0 ELSE 1 END AS INTEGER) AS tier FROM (SELECT 'kingdom' AS rank, kingdom AS name, CAST(sum(record_count) AS BIGINT) AS records FROM card GROUP BY 2 UNION ALL SELECT 'phylum', phylum, CAST(sum(record_count) AS BIGINT) FROM card GROUP BY 2) WHERE ' ' || {DUCK_NORM.format('name')} LIKE '% brand 1%'", "card")
def rank_search(r):
    top = r.card.groupBy(F.col("kingdom").alias("name")).agg(F.sum("record_count").alias("records")).withColumn("rank", F.lit("kingdom"))
    rows = top.unionByName(r.card.groupBy(F.col("phylum").alias("name")).agg(F.sum("record_count").alias("records")).withColumn("rank", F.lit("phylum")))
    norm = tx.search_norm(F.col("name"))
    return rows.where(tx.has_word_starting(F.concat(F.lit(" "), norm), "brand 1")).select("rank", "name", "records", F.when(norm == "brand 1", 0).otherwise(1).alias("tier"))


HIDDEN = [f"K{i}" for i in range(0, 3000, 3)]
_HIDDEN = "CAST(substr(specieskey, 2) AS BIGINT) % 3 = 0 AND CAST(substr(specieskey, 2) AS BIGINT) < 3000"


def _atlas(r, hidden=None):
    return Atlas(r.spark, {"species_hex": r.hex, "species_card": r.card}, hidden)


@query(f"SELECT specieskey, CAST(sum(occurrences) AS BIGINT) AS records FROM hex WHERE specieskey IN ({MEMBERS}) AND NOT ({_HIDDEN}) AND year BETWEEN 1996 AND 1999 GROUP BY 1", "hex", "card")
def rank_card_hidden(r):
    return _atlas(r, HIDDEN).rank_card({"kingdom": "PROMO", "phylum": "Brand#3"}, 1996, 1999, size=None)["results"].select("specieskey", "records")


@query(f"SELECT class_ AS name, count(*) AS species, CAST(sum(records) AS BIGINT) AS records FROM (SELECT specieskey, sum(occurrences) AS records FROM hex GROUP BY 1) h JOIN card USING (specieskey) WHERE specieskey IN ({MEMBERS}) AND NOT ({_HIDDEN}) GROUP BY 1", "hex", "card")
def rank_children_hidden(r):
    return _atlas(r, HIDDEN).rank_card({"kingdom": "PROMO", "phylum": "Brand#3"}, size=None)["children"]


@query(f"SELECT CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS no_year FROM hex WHERE year IS NULL AND specieskey IN ({MEMBERS}) AND NOT ({_HIDDEN})", "hex", "card")
def rank_undated_hidden(r):
    return _atlas(r, HIDDEN).rank_card({"kingdom": "PROMO", "phylum": "Brand#3"}, 1996, 1999)["undated"]


@query(f"SELECT h3_r4 AS cell, CAST(sum(occurrences) AS BIGINT) AS records, CAST(count(DISTINCT specieskey) AS INTEGER) AS distinct_species FROM hex WHERE specieskey IN ({MEMBERS}) AND NOT ({_HIDDEN}) AND h3_r4 IS NOT NULL GROUP BY 1", "hex", "card")
def rank_map_hidden(r):
    return _atlas(r, HIDDEN).rank_hexes({"kingdom": "PROMO", "phylum": "Brand#3"}, 4)["cells"]


_BUSIEST = "(SELECT h3_r4 FROM hex WHERE h3_r4 IS NOT NULL GROUP BY 1 ORDER BY sum(occurrences) DESC, h3_r4 LIMIT 1)"


@query(f"SELECT year, CAST(sum(occurrences) AS BIGINT) AS records FROM hex WHERE h3_r4 = {_BUSIEST} AND coalesce(NOT ({_HIDDEN}), true) GROUP BY 1", "hex")
def cell_years_hidden(r):
    return _atlas(r, HIDDEN).cell_species(_busy(r, 1).first().cell)["by_year"]


_INDEX = "SELECT *, CASE WHEN norm = '{q}' THEN 0 WHEN ' ' || norm LIKE '% {q}%' THEN 1 ELSE 2 END AS tier FROM (SELECT *, " + DUCK_NORM.format("name") + " AS norm FROM (" + " UNION ALL ".join(
    f"SELECT '{_SHOWN[i].strip(chr(34))}' AS rank, {i} AS depth, {c} AS name, [{', '.join(reversed([f'coalesce({x}, {chr(39)*2})' for x in _PATH[:i]]))}]::VARCHAR[] AS above, "
    + ", ".join(f"{p if j <= i else 'CAST(NULL AS VARCHAR)'} AS {_SHOWN[j]}" for j, p in enumerate(_PATH)) + f", count(*) AS species, CAST(sum(record_count) AS BIGINT) AS records FROM card WHERE {c} IS NOT NULL AND NOT ({_HIDDEN}) GROUP BY " + ", ".join(_PATH[: i + 1])
    for i, c in enumerate(_PATH)
) + "))"
_BEST = "SELECT * FROM (" + _INDEX + ") WHERE norm LIKE '%{q}%' ORDER BY tier, records DESC, depth, name, " + ", ".join(f"{c} NULLS FIRST" for c in _SHOWN) + " LIMIT {n}"


@query("SELECT rank, name, " + ", ".join(_SHOWN) + ", species, records, CAST(tier AS INTEGER) AS tier FROM (" + _BEST.format(q="and 1", n=20) + ")", "card")
def rank_search_contains(r):
    """Nothing begins a word with it: all hits are of the last tier."""
    return _atlas(r, HIDDEN).search("AND#1", rank_limit=20)["ranks"].select("rank", "name", *species.RANKS, "species", "records", "tier")


_NAMED = "list_filter({0}, lambda z: z <> '')[1]"
_RANKS_ABOVE = "list_reverse(['kingdom', 'phylum', 'class', 'order', 'family', 'genus'][1:h.depth])"


@query(
    f"""SELECT rank, name, upper(rank[1]) || substr(rank, 2) || ' ' || name || CASE WHEN {_NAMED.format('above')} IS NULL THEN '' WHEN alone THEN ' (' || {_NAMED.format('above')} || ')' ELSE ' (' || array_to_string(list_transform(range(1, k + 1), lambda i: CASE WHEN above[i] <> '' THEN above[i] ELSE 'no ' || ranks_above[i] END), ', ') || ')' END AS label FROM (
    SELECT rank, name, above, {_RANKS_ABOVE} AS ranks_above,
    NOT EXISTS (SELECT 1 FROM ({_INDEX.format(q='x')}) o WHERE o.rank = h.rank AND o.name = h.name AND o.above <> h.above AND {_NAMED.format('o.above')} IS NOT DISTINCT FROM {_NAMED.format('h.above')}) AS alone,
    coalesce((SELECT min(c.k) FROM (SELECT unnest(range(1, 6)) AS k) c WHERE c.k <= len(h.above) AND {_NAMED.format('h.above[1:c.k]')} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({_INDEX.format(q='x')}) o WHERE o.rank = h.rank AND o.name = h.name AND o.above <> h.above AND o.above[1:c.k] = h.above[1:c.k])), len(above)) AS k
    FROM ({_BEST.format(q='f1', n=12)}) h)""",
    "card",
)
def rank_labels(r):
    """Families of one name under many orders, whose nearest parents are shared."""
    return _atlas(r, HIDDEN).search("F1", rank_limit=12)["ranks"].select("rank", "name", "label")


NAMES = f"(SELECT DISTINCT specieskey, 'col_name' AS field, col_name AS name, {DUCK_NORM.format('col_name')} AS norm FROM card)"


@query(f"SELECT * FROM {NAMES} WHERE norm <> ''", "card")
def search_index(r):
    return cat.search_names(r.card)


@query(f"SELECT specieskey, 'col_name' AS field, name, CAST(CASE WHEN norm = 'red widget 1' THEN 0 WHEN norm LIKE 'red widget 1%' OR norm LIKE '% red widget 1%' THEN 1 ELSE 2 END AS INTEGER) AS tier, col_name, record_count FROM {NAMES} JOIN card USING (specieskey) WHERE norm LIKE '%red widget 1%' AND specieskey <> 'K1' ORDER BY tier, record_count DESC, col_name, specieskey LIMIT 50", "card")
def search_tiers(r):
    return cat.tiered_search(cat.search_names(r.card), r.card, "Red WIDGET 1", 50, hidden=["K1"])


@query(f"SELECT DISTINCT specieskey FROM {NAMES} WHERE norm LIKE '%ring 5%'", "card")
def name_filter_keys(r):
    return cat.search_names(r.card).where(F.contains("norm", F.lit("ring 5"))).select("specieskey").distinct()


TEXTS = ["title", "abstract"]
DUCK_TEXT = "' ' || " + DUCK_NORM.format("concat_ws(' ', title, abstract)")
DUCK_TITLE = "' ' || " + DUCK_NORM.format("title")


def _catalogue(r):
    uri = F.when(F.col("doc_id") % 5 == 0, datasets.OPEN_URI).when(F.col("doc_id") % 5 == 1, datasets.RESTRICTED_URI)
    rows = r.records.withColumns({"subjects": F.lit(None).cast("array<string>"), "licences": F.array(F.struct(F.lit("x").alias("name"), uri.alias("uri"))), "organisms": F.array("lang"), "mappable": F.col("doc_id") % 2 == 0})
    return datasets.search_columns(rows)


DUCK_ACCESS = "CASE doc_id % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'restricted' ELSE '' END"
DUCK_YEAR = "TRY_CAST(substr(nullif(issued, ''), 1, 4) AS INTEGER)"


@query(f"SELECT id, CAST(row_number() OVER (ORDER BY CASE WHEN {DUCK_TITLE} LIKE '% th%' THEN 0 ELSE 1 END, nullif(issued, '') DESC NULLS LAST, id) AS INTEGER) AS place FROM records WHERE {DUCK_TEXT} LIKE '% th%' ORDER BY place LIMIT 40", "records")
def dataset_search_relevance(r):
    from pyspark.sql import Window

    where = datasets.conditions(["th"])
    top = datasets.matching(_catalogue(r), where).orderBy(*datasets.order("relevance", ["th"])).limit(40)
    return top.select("id", F.row_number().over(Window.orderBy(*datasets.order("relevance", ["th"]))).alias("place"))


@query(f"SELECT id, title, CAST(CASE WHEN regexp_matches(lower(strip_accents(substr(title_start, 1, 1))), '^[a-z]') THEN 0 WHEN regexp_matches(title_start, '^[0-9]') THEN 1 ELSE 2 END AS INTEGER) AS title_group, ltrim(regexp_extract(title_start, '^[0-9]+'), '0') AS title_number FROM (SELECT *, regexp_replace(trim(coalesce(title, '')), '^[[(\"''“”‘’«»„ ]+', '') AS title_start FROM records)", "records")
def dataset_sort_title(r):
    return _catalogue(r).select("id", "title", "title_group", "title_number")


_FACETS = {"catalogue": "source", "final_class": "final_class", "frontend_group": "frontend_group", "access": DUCK_ACCESS, "published": f"CAST({DUCK_YEAR} AS VARCHAR)", "mappable": "CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END"}
_ASKED = {"query": f"({DUCK_TEXT}) LIKE '% th%'", "final_class": "final_class IN ('bc_only', 'global')", "access": f"{DUCK_ACCESS} IN ('open')", "published": f"coalesce({DUCK_YEAR} BETWEEN 1995 AND 2010, false)"}


@query(" UNION ALL ".join(f"SELECT '{n}' AS facet, {c} AS value, count(*) AS datasets FROM records WHERE " + " AND ".join(s for a, s in _ASKED.items() if a != n) + " GROUP BY 2" for n, c in _FACETS.items()), "records")
def dataset_facets(r):
    where = datasets.conditions(["th"], final_class=["bc_only", "global"], access=["open"], years=(1995, 2010))
    return datasets.facets(_catalogue(r), where)


@query(f"SELECT id FROM records WHERE frontend_group IN ('bc_data', 'pending') AND doc_id % 2 = 0 AND {DUCK_YEAR} BETWEEN 2000 AND 99999 ORDER BY nullif(issued, '') NULLS LAST, id LIMIT 20 OFFSET 20", "records")
def dataset_page(r):
    where = datasets.conditions(frontend_group=["bc_data", "pending"], years=(2000, None), mappable=True)
    return datasets.matching(_catalogue(r), where).orderBy(*datasets.order("oldest")).offset(20).limit(20).select("id")


@query("SELECT conv_id, count(*) AS names, count(DISTINCT role) AS linked, count(*) FILTER (WHERE role = 'user') AS asked FROM conversations JOIN documents ON conv_id = doc_id GROUP BY 1")
def linked_species_counts(r):
    rows = r.table("conversations").join(r.table("documents").select(F.col("doc_id").alias("conv_id")), "conv_id")
    return rows.groupBy("conv_id").agg(F.count("*").alias("names"), F.countDistinct("role").alias("linked"), F.count_if(F.col("role") == "user").alias("asked"))


@query("SELECT DISTINCT doc_id + 7 AS doc_id FROM documents WHERE doc_id + 7 NOT IN (SELECT doc_id FROM labels)")
def anti_join_orphans(r):
    return checks.orphans(r.table("documents").select((F.col("doc_id") + 7).alias("doc_id")), "doc_id", r.table("labels"), "doc_id")


@query("SELECT conv_id, turn // 2 AS half, count(*) AS rows FROM conversations GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_positions(r):
    return checks.repeated_keys(r.table("conversations").select("conv_id", F.floor(F.col("turn") / 2).alias("half")), ["conv_id", "half"])


@query("SELECT gbifid, file_row, CAST(row_number() OVER (PARTITION BY gbifid ORDER BY file_row) AS INTEGER) AS media_order FROM (SELECT l_orderkey AS gbifid, l_linenumber AS file_row FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))")
def media_order(r):
    return species.media_order(r.table("lineitem").select(F.col("l_orderkey").alias("gbifid"), F.col("l_linenumber").alias("file_row")).distinct())


@query("SELECT user_id AS id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def latest_per_id(r):
    return cat.latest_per_id(r.table("events").select(F.col("user_id").alias("id"), "event_id", "ts"), "ts", "event_id")


VERSIONS = """(SELECT 'v' || event_id AS id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 's' || (event_id % 800) END AS "seriesId", CASE WHEN event_id % 11 = 3 THEN 'v' || (event_id - 3) END AS older, ts FROM events)"""


@query(
    f"""SELECT v.id, CASE WHEN p.replaced IS NOT NULL OR (k.keeper IS NOT NULL AND k.keeper <> v.id) THEN 'old' ELSE 'latest' END AS version_status,
    CASE WHEN p.replaced IS NOT NULL AND k.keeper <> v.id THEN 'replaced+older_in_series' WHEN p.replaced IS NOT NULL THEN 'replaced' WHEN k.keeper <> v.id THEN 'older_in_series' ELSE '' END AS old_reason,
    CASE WHEN p.replaced IS NOT NULL THEN p.replaced WHEN k.keeper <> v.id THEN k.keeper END AS newer_id
    FROM {VERSIONS} v LEFT JOIN (SELECT older, string_agg(DISTINCT id, ' ' ORDER BY id) AS replaced FROM {VERSIONS} WHERE older IS NOT NULL AND older <> id GROUP BY 1) p ON p.older = v.id
    LEFT JOIN (SELECT v2.id, first_value(v2.id) OVER (PARTITION BY "seriesId" ORDER BY (p2.older IS NULL) DESC, ts DESC, v2.id DESC) AS keeper FROM {VERSIONS} v2 LEFT JOIN (SELECT DISTINCT older FROM {VERSIONS} WHERE older <> id) p2 ON p2.older = v2.id WHERE "seriesId" IS NOT NULL) k ON k.id = v.id"""
)
def version_marking(r):
    e = r.table("events")
    name = lambda n: F.concat(F.lit("v"), n.cast("string"))
    older = F.when(F.col("event_id") % 11 == 3, F.array(name(F.col("event_id") - 3)))
    rows = e.select(name(F.col("event_id")).alias("id"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("s"), (F.col("event_id") % 800).cast("string"))).alias("seriesId"), older.alias("obsoletes"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("dateUploaded"), F.lit(None).cast("string").alias("dateModified"))
    return cat.version_marks(rows).select("id", "version_status", "old_reason", "newer_id")


LICENCES = {
    "http://creativecommons.org/licenses/by/4.0/": "CC_BY_4_0", "CC BY-NC 4.0": "CC_BY_NC_4_0", "Anna (cc-by-sa)": "CC_BY_SA", "CC0_1_0": "CC0_1_0", "public domain": "PDM_1_0",
    "Creative Commons Attribution NonCommercial NoDerivs 3.0": "CC_BY_NC_ND_3_0", "cc_by_nc_sa_2": "CC_BY_NC_SA_2_0", "cc by sa nd 4.0": None, "all rights reserved": None, "": None, "https://creativecommons.org/publicdomain/zero/1.0/": "CC0_1_0",
}
_LICENCE_CASE = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(LICENCES))
_CODE_CASE = " ".join(f"WHEN {i} THEN {repr(c) if c else 'NULL'}" for i, c in enumerate(LICENCES.values()))


def _licensed(r):
    text = F.element_at(F.array(*map(F.lit, LICENCES)), (F.col("p_partkey") % len(LICENCES) + 1).cast("int"))
    return r.table("part").withColumn("license", text)


@query(f"SELECT CASE p_partkey % {len(LICENCES)} {_LICENCE_CASE} END AS license, CASE p_partkey % {len(LICENCES)} {_CODE_CASE} END AS code, count(*) AS images FROM part GROUP BY 1, 2")
def license_codes(r):
    texts = _licensed(r).groupBy("license").agg(F.count("*").alias("images"))
    return texts.select("license", licence.licence_code(F.col("license")).alias("code"), "images")


@query(f"SELECT p_partkey, (p_partkey % 13 <> 0 AND p_partkey % 6 <> 0 AND coalesce(CASE p_partkey % {len(LICENCES)} {_CODE_CASE} END, 'CC_BY_SA') <> 'CC_BY_SA') AS shown FROM part")
def credit_check(r):
    rows = _licensed(r).withColumns({"link": F.when(F.col("p_partkey") % 13 == 0, "  ").otherwise("http://x"), "creator": F.when(F.col("p_partkey") % 6 != 0, "A")})
    return rows.select("p_partkey", licence.may_be_shown(F.lit("u"), F.col("link"), F.col("creator"), licence.licence_code(F.col("license"))).alias("shown"))


@query(
    f"""SELECT specieskey, gbifid, license_rank FROM (SELECT 'K' || l_partkey AS specieskey, l_orderkey * 10 + l_linenumber AS gbifid, CAST(CASE l_orderkey % {len(LICENCES)} WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 7 WHEN 6 THEN 6 WHEN 10 THEN 1 END AS INTEGER) AS license_rank, l_shipdate FROM lineitem) WHERE license_rank IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY specieskey ORDER BY license_rank, l_shipdate DESC, gbifid) = 1"""
)
def species_image_pick(r):
    li = r.table("lineitem").withColumn("gbifid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    code = F.element_at(F.array(*map(F.lit, LICENCES.values())), (F.col("l_orderkey") % len(LICENCES) + 1).cast("int"))
    media = li.dropDuplicates(["gbifid"]).select("gbifid", F.lit(1).alias("media_order"), F.lit("StillImage").alias("type"), F.lit("u").alias("identifier"), F.lit("l").alias("references"), F.lit("a").alias("creator"), F.lit(None).cast("string").alias("rightsholder"), code.alias("license_code"))
    records = li.select("gbifid", F.concat(F.lit("K"), F.col("l_partkey").cast("string")).alias("specieskey"), F.col("l_shipdate").alias("eventdate"))
    return species.species_images(records, media).select("specieskey", "gbifid", "license_rank").distinct()


@query("SELECT datasetkey, publisher FROM (SELECT l_suppkey AS datasetkey, l_returnflag AS publisher, count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY datasetkey ORDER BY n DESC, publisher) = 1")
def publisher_argmax(r):
    return species.publisher_of(r.table("lineitem").select(F.col("l_suppkey").alias("datasetkey"), F.col("l_returnflag").alias("publisher")))


_OLD, _NEW = "(SELECT o_orderkey AS k, o_orderstatus AS s, o_custkey AS c FROM orders WHERE o_orderkey % 10 <> 3)", "(SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS s, o_custkey AS c FROM orders WHERE o_orderkey % 10 <> 4)"


def _slices(r):
    o = r.table("orders")
    old = o.where("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_custkey").alias("c"))
    new = o.where("o_orderkey % 10 <> 4").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderstatus")).alias("s"), F.col("o_custkey").alias("c"))
    return old, new


@query(f"SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'gained' WHEN b.k IS NULL THEN 'lost' WHEN a.s IS NOT DISTINCT FROM b.s AND a.c IS NOT DISTINCT FROM b.c THEN 'unchanged' ELSE 'changed' END AS status FROM {_OLD} a FULL JOIN {_NEW} b ON a.k = b.k")
def table_diff_full_outer(r):
    return rel.difference(*_slices(r), "k", ["s", "c"])


@query(f"SELECT *, 'left' AS side FROM ({_OLD} EXCEPT ALL {_NEW}) UNION ALL SELECT *, 'right' AS side FROM ({_NEW} EXCEPT ALL {_OLD})")
def table_equality_except(r):
    return rel.unequal_rows(*_slices(r)).select("k", "s", "c", "side")


@query("SELECT l_returnflag AS source, count(*) AS records, count(DISTINCT l_suppkey) AS publishers FROM lineitem GROUP BY 1 UNION ALL SELECT 'all', count(*), count(DISTINCT l_suppkey) FROM lineitem")
def publisher_subtotals(r):
    rows = r.table("lineitem").select(F.explode(F.array("l_returnflag", F.lit("all"))).alias("source"), "l_suppkey")
    return rows.groupBy("source").agg(F.count("*").alias("records"), F.countDistinct("l_suppkey").alias("publishers"))


@query("SELECT l_linestatus, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS m{i}" for i, c in enumerate(["l_quantity < 10", "l_quantity >= 40", "l_discount > 0.05", "l_tax = 0", "l_returnflag = 'R'", "year(l_shipdate) < 1998"])) + ", count(DISTINCT CASE WHEN l_quantity > 30 THEN l_suppkey END) AS m6 FROM lineitem GROUP BY 1")
def conditional_measures(r):
    tests = ["l_quantity < 10", "l_quantity >= 40", "l_discount > double(0.05)", "l_tax = 0", "l_returnflag = 'R'", "year(l_shipdate) < 1998"]
    return r.table("lineitem").groupBy("l_linestatus").agg(*(F.count_if(F.expr(c)).alias(f"m{i}") for i, c in enumerate(tests)), F.countDistinct(F.when(F.col("l_quantity") > 30, F.col("l_suppkey"))).alias("m6"))


@query("SELECT l_returnflag, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus) AS states, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS numbers FROM lineitem GROUP BY 1")
def ordered_string_agg(r):
    joined = lambda c, by: F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), by)
    return r.table("lineitem").groupBy("l_returnflag").agg(joined("l_linestatus", "|").alias("states"), joined("l_linenumber", ",").alias("numbers"))


WORDS = ["the", "license", "token", "queux", "stheit", "password", "of thing"]
_WORD = "(?i)(?:^|[^a-zA-Z])(?:{0})(?:[^a-zA-Z]|$)"
_FORMS = {w: "|".join(tx.plural_forms(w)) for w in WORDS}


@query("SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(text, '{_WORD.format(f)}') THEN '{w}' END" for w, f in _FORMS.items()) + ") AS hits FROM documents")
def keyword_hits(r):
    return r.table("documents").select("doc_id", F.array_join(tx.keyword_hits(F.col("text"), WORDS), ",").alias("hits"))


@query(" UNION ALL ".join(f"SELECT * FROM (SELECT '{w}' AS keyword, count(*) AS records FROM documents WHERE regexp_matches(text, '{_WORD.format(f)}')) WHERE records > 0" for w, f in _FORMS.items()))
def keyword_counts(r):
    return r.table("documents").select(F.explode(tx.keyword_hits(F.col("text"), WORDS)).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("records"))


@query(f"SELECT doc_id, regexp_matches(regexp_replace(text, '(?i)the thing|the', ' ', 'g'), '{_WORD.format('of|ofs|in|ins')}') AS found FROM documents")
def keyword_mask(r):
    return r.table("documents").select("doc_id", tx.has_keyword(tx.mask_phrases(F.col("text"), ["the", "the thing"]), ["of", "ofs", "in", "ins"]).alias("found"))


@query("SELECT DISTINCT a.p_name AS name_norm, b.name AS near, CAST(levenshtein(a.p_name, b.name) AS INTEGER) AS distance FROM (SELECT DISTINCT p_name FROM part WHERE length(p_name) >= 5) a JOIN (SELECT DISTINCT replace(p_name, 'e', 'a') AS name FROM part) b ON left(a.p_name, 1) = left(b.name, 1) AND length(b.name) BETWEEN length(a.p_name) - 2 AND length(a.p_name) + 2 WHERE levenshtein(a.p_name, b.name) BETWEEN 1 AND 2")
def fuzzy_band_join(r):
    names = r.table("part").select(F.col("p_name").alias("norm")).distinct()
    known = r.table("part").select(F.replace("p_name", F.lit("e"), F.lit("a")).alias("norm")).distinct()
    return cat.near_names(names, known).select("name_norm", F.col("norm").alias("near"), "distance").distinct()


SQUARE = [(-139.0, 48.0), (-114.0, 48.0), (-114.0, 60.0), (-139.0, 60.0)]
TRIANGLE = [(-139.0, 60.0), (-114.0, 60.0), (-126.5, 48.0)]


@query("SELECT s_suppkey, (lon > -139 AND lon < -114 AND lat > 48 AND lat < 60) AS inside, (lon >= -139 AND lon <= -114 AND lat >= 48 AND lat <= 60) AS covered FROM (SELECT s_suppkey, CAST(-145 + s_suppkey % 40 AS DOUBLE) AS lon, CAST(45 + s_suppkey % 19 AS DOUBLE) AS lat FROM supplier)")
def point_in_polygon(r):
    s = r.table("supplier").select("s_suppkey", (F.col("s_suppkey") % 40 - 145).cast("double").alias("lon"), (F.col("s_suppkey") % 19 + 45).cast("double").alias("lat"))
    return s.select("s_suppkey", polygons.in_ring(F.col("lon"), F.col("lat"), SQUARE).alias("inside"), polygons.in_ring(F.col("lon"), F.col("lat"), SQUARE, boundary=True).alias("covered"))


@query("SELECT s_suppkey, CASE WHEN lon >= -139 AND lon <= -114 AND lat >= 48 AND lat <= 60 THEN 'inside' WHEN -lon >= -139 AND -lon <= -114 AND lat >= 48 AND lat <= 60 THEN 'sign_typo' ELSE 'outside' END AS point_class FROM (SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 2 = 0 THEN -145 + s_suppkey % 40 ELSE 145 - s_suppkey % 40 END AS DOUBLE) AS lon, CAST(45 + s_suppkey % 19 AS DOUBLE) AS lat FROM supplier)")
def point_classes(r):
    lon = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey") % 40 - 145).otherwise(F.lit(145) - F.col("s_suppkey") % 40).cast("double")
    s = r.table("supplier").select("s_suppkey", lon.alias("lon"), (F.col("s_suppkey") % 19 + 45).cast("double").alias("lat"))
    within = lambda x: polygons.in_ring(x, F.col("lat"), SQUARE, boundary=True)
    return s.withColumns({"a": within(F.col("lon")), "b": within(-F.col("lon"))}).select("s_suppkey", F.when(F.col("a"), "inside").when(F.col("b"), "sign_typo").otherwise("outside").alias("point_class"))


_BOX = "SELECT s_suppkey, CAST(-142 + s_suppkey % 30 AS DOUBLE) - 0.3 AS w, CAST(46 + s_suppkey % 13 AS DOUBLE) AS s, CAST(-142 + s_suppkey % 30 + 1 + s_suppkey % 25 AS DOUBLE) AS e, CAST(least(46 + s_suppkey % 13 + 1 + s_suppkey % 14, 80) AS DOUBLE) AS n FROM supplier"
_IN = "greatest(0, least(e, -114) - greatest(w, -139)) * greatest(0, sin(radians(least(n, 60))) - sin(radians(greatest(s, 48))))"
_REG, _OWN = "(25 * (sin(radians(60)) - sin(radians(48))))", "((e - w) * (sin(radians(n)) - sin(radians(s))))"


@query(
    f"""SELECT s_suppkey, CASE WHEN share < 0.02 AND cover < 0.02 THEN 'outside' WHEN size >= 5 THEN 'huge' WHEN share >= 0.9 THEN 'inside' WHEN cover >= 0.8 AND abs(w + 139) <= 1 AND abs(e + 114) <= 1 AND abs(s - 48) <= 1 AND abs(n - 60) <= 1 THEN 'bc_wide' WHEN share >= 0.5 THEN 'mostly_bc' ELSE 'partly_bc' END AS box_class, round(share, 4) AS box_share, round(size, 4) AS box_size
    FROM (SELECT *, {_IN} / {_OWN} AS share, {_IN} / {_REG} AS cover, {_OWN} / {_REG} AS size FROM ({_BOX}))"""
)
def box_classes(r):
    k = F.col("s_suppkey")
    box = r.table("supplier").select("s_suppkey", ((k % 30 - 142).cast("double") - 0.3).alias("w"), (k % 13 + 46).cast("double").alias("s"), (k % 30 - 141 + k % 25).cast("double").alias("e"), F.least(k % 13 + 47 + k % 14, F.lit(80)).cast("double").alias("n"))
    out = polygons.classify_boxes(box, SQUARE)
    return out.select("s_suppkey", "box_class", "box_share", "box_size")


@query(
    """SELECT s_suppkey, CASE WHEN alone OR kinds <> 1 THEN 'needs_llm' WHEN yes > 0 THEN 'bc' ELSE 'not_bc' END AS bc_class, CASE WHEN alone OR yes + no = 0 THEN 'none' ELSE rules END AS decided_by FROM (
    SELECT s_suppkey, (box IN ('inside', 'bc_wide'))::INT + (point = 'inside')::INT + (kind = 'bc')::INT AS yes, (box = 'outside')::INT + (point = 'outside')::INT + (kind = 'not_bc')::INT AS no, (yes > 0)::INT + (no > 0)::INT AS kinds,
    box = 'huge' AND kind <> 'other' AND point = 'sign_typo' AS alone, concat_ws('+', CASE WHEN box IN ('inside', 'bc_wide', 'outside') THEN 'box' END, CASE WHEN point IN ('inside', 'outside') THEN 'point' END, CASE WHEN kind <> 'other' THEN 'source' END) AS rules
    FROM (SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'inside' WHEN 1 THEN 'bc_wide' WHEN 2 THEN 'mostly_bc' WHEN 3 THEN 'partly_bc' WHEN 4 THEN 'huge' ELSE 'outside' END AS box, CASE s_suppkey // 6 % 3 WHEN 0 THEN 'inside' WHEN 1 THEN 'outside' ELSE 'sign_typo' END AS point, CASE s_suppkey // 18 % 3 WHEN 0 THEN 'bc' WHEN 1 THEN 'not_bc' ELSE 'other' END AS kind FROM supplier))"""
)
def vote_combination(r):
    k = F.col("s_suppkey")
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))
    third = lambda n: F.floor(k / n) % 3
    votes = cat.combine_votes(F.array(pick(cat.BOX_ORDER, k % 6)), F.array(pick(["inside", "outside", "sign_typo"], third(6))), pick(["bc", "not_bc", "other"], third(18)))
    return r.table("supplier").select("s_suppkey", votes.alias("v")).select("s_suppkey", "v.*")


_FACT = {"a": "o_orderkey % 3", "b": "o_orderkey // 3 % 2", "c": "o_orderkey // 6 % 2", "d": "o_orderkey // 12 % 2", "g": "o_orderkey // 24 % 2"}


@query("SELECT CASE WHEN g = 1 THEN 'global' WHEN c = 1 AND (a = 1 OR d = 1) THEN 'bc_and_outside_canada' WHEN d = 1 THEN 'all_canada' WHEN a = 1 AND b = 1 THEN 'canada_incl_bc' WHEN a = 1 THEN 'bc_only' WHEN a = 0 THEN 'elsewhere' ELSE 'unknown' END AS class, count(*) AS records FROM (SELECT " + ", ".join(f"{s} AS {n}" for n, s in _FACT.items()) + " FROM orders) GROUP BY 1")
def decision_table(r):
    k = F.col("o_orderkey")
    said = lambda n: F.when(F.floor(k / n) % 2 == 1, "yes").otherwise("no")
    three = F.when(k % 3 == 1, "yes").when(k % 3 == 0, "no").otherwise("unclear")
    return r.table("orders").select(cat.class_of(three, said(3), said(6), said(12), said(24)).alias("class")).groupBy("class").agg(F.count("*").alias("records"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'bc_only' WHEN o_orderkey % 3 = 1 THEN 'elsewhere' WHEN o_orderstatus = 'O' AND m IN ('elsewhere', 'unknown') THEN 'bc_only' ELSE m END AS final_class, CASE WHEN o_orderkey % 3 < 2 THEN 'rule' WHEN o_orderstatus = 'O' AND m IN ('elsewhere', 'unknown') THEN 'bc_only_catalogue' ELSE 'llm' END AS decided_by FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'elsewhere' WHEN 1 THEN 'unknown' ELSE 'global' END AS m FROM orders)")
def final_classes(r):
    k = F.col("o_orderkey")
    rule = F.when(k % 3 == 0, "bc").when(k % 3 == 1, "not_bc").otherwise("needs_llm")
    model = F.when(k % 4 == 0, "elsewhere").when(k % 4 == 1, "unknown").otherwise("global")
    return r.table("orders").select("o_orderkey", cat.final_class(rule, model, F.col("o_orderstatus"), ["O"], ["elsewhere", "unknown"]).alias("f")).select("o_orderkey", "f.*")


def _copies(r):
    return r.records.withColumn("title", F.col("abstract")).join(cat.copy_groups(r.records), "id")


_GROUPED = "(SELECT *, min(id) OVER (PARTITION BY regexp_replace(lower(abstract), '[^a-z0-9]+', ' ', 'g'), trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))) AS g FROM records)"
_COPY = "(SELECT r.*, CASE WHEN trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', ' ', 'g')) = '' THEN id ELSE min(id) OVER (PARTITION BY trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', ' ', 'g')), trim(regexp_replace(lower(coalesce(abstract, '')), '[^a-z0-9]+', ' ', 'g'))) END AS copy_group FROM records r)"


@query(f"SELECT id, copy_group FROM {_COPY}", "records")
def copy_groups(r):
    return cat.copy_groups(r.records)


@query(f"SELECT id, copy_group, copy_count FROM (SELECT *, count(*) OVER (PARTITION BY copy_group) AS copy_count FROM {_COPY}) QUALIFY row_number() OVER (PARTITION BY copy_group ORDER BY CASE frontend_group WHEN 'bc_data' THEN 1 WHEN 'pending' THEN 2 ELSE 3 END, nullif(issued, '') DESC NULLS LAST, id) = 1", "records")
def shown_copies(r):
    rows = r.records.join(cat.copy_groups(r.records), "id").withColumn("datestamp", F.lit(None).cast("string"))
    return cat.shown_copies(rows, ["bc_data", "pending"]).select("id", "copy_group", "copy_count")


@query(f"SELECT copy_group, count(DISTINCT final_class) AS n, string_agg(DISTINCT final_class, ',' ORDER BY final_class) AS found FROM {_COPY} GROUP BY 1 HAVING count(DISTINCT final_class) > 1", "records")
def group_conflicts(r):
    return cat.group_conflicts(r.records.join(cat.copy_groups(r.records), "id"), "final_class")


_NORMED = f"(SELECT doc_id, text, {DUCK_NORM.format('text')} AS norm FROM documents WHERE text <> '')"


@query(f"SELECT left_id, right_id, concat_ws('+', CASE WHEN bool_or(w = 'text') THEN 'text' END, CASE WHEN bool_or(w = 'norm') THEN 'norm' END) AS ways, CASE WHEN bool_or(w = 'text') THEN 'text' ELSE 'norm' END AS strongest FROM (SELECT a.doc_id AS left_id, b.doc_id AS right_id, unnest(CASE WHEN a.text = b.text THEN ['text', 'norm'] ELSE ['norm'] END) AS w FROM {_NORMED} a JOIN (SELECT min(doc_id) AS doc_id, text, any_value(norm) AS norm FROM {_NORMED} GROUP BY text) b ON a.norm = b.norm AND (a.norm <> '' OR a.text = b.text)) WHERE w = 'text' OR EXISTS (SELECT 1 FROM {_NORMED} n WHERE n.doc_id = left_id AND n.norm <> '') GROUP BY 1, 2")
def linkage_multi_key(r):
    """Each document with the first document of each text that is the same, or the same in search form."""
    docs = r.table("documents").select(F.col("doc_id").alias("id"), "text", tx.search_norm(F.col("text")).alias("norm")).where("text <> ''")
    firsts = docs.groupBy("text", "norm").agg(F.min("id").alias("id"))
    digest = lambda c: F.when(F.col(c) != "", F.sha2(c, 256))
    return cat.link_by_any(docs, firsts, {"text": (digest("text"), digest("text")), "norm": (digest("norm"), digest("norm"))})


_STAMP = "CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y') WHEN 1 THEN strftime(ts, '%Y-%m') WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M') WHEN 3 THEN strftime(ts, '%Y-%m-%d') || '/' || strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END"


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('year', ts) WHEN 1 THEN date_trunc('month', ts) WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END::TIMESTAMP AS started FROM events")
def partial_dates(r):
    k, form = F.col("event_id") % 5, lambda f: F.date_format("ts", f)
    text = F.when(k == 0, form("yyyy")).when(k == 1, form("yyyy-MM")).when(k == 2, form("yyyy-MM-dd'T'HH:mm")).when(k == 3, F.concat(form("yyyy-MM-dd"), F.lit("/"), form("yyyy-MM-dd"))).otherwise(form("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return r.table("events").select("event_id", dates.partial_timestamp(text).alias("started"))


@query("SELECT gbifid, coalesce(len(list_filter(list_transform(string_split(issue_text, ';'), lambda x: trim(x)), lambda x: x <> '')), -1)::INTEGER AS flags, list_contains(list_transform(string_split(issue_text, ';'), lambda x: trim(x)), 'OTHER') AS other FROM occ", "occ")
def array_flags(r):
    issue = tx.split_list(F.col("issue_text"))
    return r.occ.select("gbifid", F.coalesce(F.when(F.col("issue_text").isNotNull(), F.size(issue)), F.lit(-1)).alias("flags"), F.array_contains(issue, "OTHER").alias("other"))


@query("SELECT user_id, string_agg(event_type || ':' || n, ';' ORDER BY n DESC, event_type) AS listed FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def struct_lists(r):
    counts = r.table("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "event_type", "n")))
    return counts.groupBy("user_id").agg(F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["event_type"], x["n"].cast("string"))), ";").alias("listed"))


@query(
    r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n ]+', ' ', 'g'), ' ') AS text FROM pages"""
)
def html_to_text(r):
    return r.table("pages").select("page_id", tx.plain_text(F.col("html")).alias("text"))


@query(f"SELECT specieskey, CAST(sum(occurrences) AS BIGINT) AS records FROM hex WHERE h3_r5 IN ({', '.join(repr(c) for c in sorted(grid.cover([(-125.0, 50.0), (-122.0, 50.0), (-122.0, 52.0), (-125.0, 52.0)], 5)))}) GROUP BY 1", "hex")
def area_species(r):
    cells = grid.cover([(-125.0, 50.0), (-122.0, 50.0), (-122.0, 52.0), (-125.0, 52.0)], 5)
    frame = r.spark.createDataFrame([(c,) for c in sorted(cells)], "cell string")
    return species.species_in_cells(r.hex, frame, 5)


@query("SELECT species, old_key, kept_key, conflict = '' AS merge, conflict AS conflicts FROM (SELECT a.p_name || a.p_size AS species, a.p_partkey AS x, b.p_partkey AS y, CASE WHEN a.p_brand <> b.p_brand THEN 'phylum' ELSE '' END AS conflict, CASE WHEN (a.p_size % 2 = 0, a.p_retailprice, -a.p_partkey) >= (b.p_size % 2 = 0, b.p_retailprice, -b.p_partkey) THEN a.p_partkey ELSE b.p_partkey END AS kept_key, CASE WHEN (a.p_size % 2 = 0, a.p_retailprice, -a.p_partkey) >= (b.p_size % 2 = 0, b.p_retailprice, -b.p_partkey) THEN b.p_partkey ELSE a.p_partkey END AS old_key FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey JOIN (SELECT p_name, p_size FROM part GROUP BY 1, 2 HAVING count(*) = 2) t ON t.p_name = a.p_name AND t.p_size = a.p_size)")
def merge_candidates(r):
    rows = r.table("part").select(F.concat("p_name", F.col("p_size").cast("string")).alias("species"), F.col("p_partkey").alias("specieskey"), F.col("p_retailprice").alias("records"), (F.col("p_size") % 2 == 0).alias("accepted"), F.col("p_brand").alias("phylum"))
    return species.merge_candidates(rows, ["phylum"]).drop("empty_levels")


@query(f"SELECT doc_id, {DUCK_NORM.format('text')} AS norm FROM documents")
def search_norm(r):
    return r.table("documents").select("doc_id", tx.search_norm(F.col("text")).alias("norm"))


#: Code points of many scripts, marks among them.
_POINTS = "SELECT chr(CAST(i AS INTEGER)) AS t, i FROM (SELECT CAST(unnest(range(1, 12032)) AS BIGINT) AS i)"


@query(f"SELECT i, strip_accents('a' || t || 'b') AS bare, strip_accents('Việt é Ünï ' || t) AS word FROM ({_POINTS})")
def accents_all(r):
    t = F.decode(F.unhex(F.lpad(F.hex("i"), 8, "0")), "UTF-32")
    rows = r.spark.range(1, 12032).select(F.col("id").alias("i"), t.alias("t"))
    return rows.select("i", tx.strip_accents(F.concat(F.lit("a"), "t", F.lit("b"))).alias("bare"), tx.strip_accents(F.concat(F.lit("Việt é Ünï "), "t")).alias("word"))


@query("SELECT doc_id, strip_accents(text) AS bare FROM documents")
def strip_accents(r):
    return r.table("documents").select("doc_id", tx.strip_accents(F.col("text")).alias("bare"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || '|' || p_brand || '|' || p_type WHEN p_partkey % 3 = 1 THEN CASE WHEN p_brand = p_name THEN p_name ELSE p_name || '|' || p_brand END ELSE p_name END AS names FROM part")
def split_names(r):
    k = F.col("p_partkey") % 3
    entry = F.when(k == 0, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(",  "), "p_type", F.lit(")"))).when(k == 1, F.concat_ws(" / ", "p_name", "p_brand")).otherwise(F.concat(F.lit("  "), "p_name", F.lit(" ")))
    return r.table("part").select("p_partkey", F.array_join(cat.split_names(entry), "|").alias("names"))


@query(
    f"""SELECT dataset_id, name_norm, CASE WHEN keys = 1 THEN 'scientific' WHEN keys > 1 THEN 'ambiguous' WHEN name_norm NOT LIKE '% %' THEN 'group_word' ELSE 'unmatched' END AS status, CASE WHEN keys = 1 THEN k END AS specieskey FROM (SELECT DISTINCT p_partkey % 50 AS dataset_id, {DUCK_NORM.format("p_name || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE ' ' || p_size END")} AS name_norm FROM part)
    LEFT JOIN (SELECT norm, count(DISTINCT 'K' || id) AS keys, min('K' || id) AS k FROM (SELECT {DUCK_NORM.format("p_name || ' ' || p_size")} AS norm, p_partkey AS id FROM part) GROUP BY 1) ON norm = name_norm"""
)
def match_names(r):
    p = r.table("part")
    organisms = p.select((F.col("p_partkey") % 50).alias("dataset_id"), F.concat("p_name", F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string")))).alias("entry"))
    cards = p.select(F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("specieskey"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("col_name"))
    genera = r.spark.createDataFrame([("none",)], "genus_norm string")
    return cat.match_names(organisms, cat.search_names(cards), genera).select("dataset_id", "name_norm", "status", "specieskey")


@query("SELECT n_nationkey AS id, r_regionkey AS place_id, 'exact' AS match, CAST(1 AS DOUBLE) AS similarity FROM nation JOIN region ON n_regionkey = r_regionkey")
def place_lookup(r):
    n = r.table("nation").join(r.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    asked = n.select(F.col("n_nationkey").alias("id"), F.concat(F.lit("The "), F.initcap("r_name")).alias("name"))
    return cat.find_places(asked, r.table("region").select(F.col("r_regionkey").alias("place_id"), cat.place_norm(F.col("r_name")).alias("norm")))


@query("SELECT s_suppkey, round(2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2)))), 3) AS km, round(6371.007180918475::DOUBLE * 6371.007180918475::DOUBLE * radians(1) * (sin(radians(lat1 + 1)) - sin(radians(lat1))), 2) AS box FROM (SELECT s_suppkey, CAST(s_suppkey % 50 AS DOUBLE) AS lat1, CAST(-120 AS DOUBLE) AS lon1, CAST(49 AS DOUBLE) AS lat2, CAST(-120 + s_suppkey % 30 AS DOUBLE) AS lon2 FROM supplier)")
def distances_and_areas(r):
    k = F.col("s_suppkey")
    lat = (k % 50).cast("double")
    km = geo.distance_km(lat, F.lit(-120.0), F.lit(49.0), (k % 30 - 120).cast("double"))
    return r.table("supplier").select("s_suppkey", F.round(km, 3).alias("km"), F.round(geo.box_area_km2(F.lit(0.0), lat, F.lit(1.0), lat + 1), 2).alias("box"))


@query("SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS w FROM documents) WHERE w NOT IN ('that', 'with') GROUP BY 1 ORDER BY n DESC, word LIMIT 100")
def word_frequency(r):
    return evaluation.word_frequency(r.table("documents"), "text", ["that", "with"], 100)


@query("SELECT count(*) AS rows, count(DISTINCT conv_id) AS ids, count(*) FILTER (WHERE trim(coalesce(text, '')) = '') AS blank, CAST(min(turn) AS BIGINT) AS first_turn, CAST(max(turn) AS BIGINT) AS last_turn FROM conversations")
def harvest_profile(r):
    more = [F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn")]
    return evaluation.profile(r.table("conversations"), "conv_id", ["text"], more).withColumnRenamed("blank_text", "blank")


@query("SELECT event_type, CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'mid' ELSE 'high' END AS bin, count(*) AS n FROM events GROUP BY 1, 2")
def value_bins(r):
    return r.table("events").select("event_type", evaluation.binned(F.col("value"), [(10.0, "low"), (50.0, "mid")], "high").alias("bin")).groupBy("event_type", "bin").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) FILTER (WHERE user_id % 3 = 0) AS a, count(*) FILTER (WHERE user_id % 3 = 1) AS b, count(*) FILTER (WHERE user_id % 3 = 2) AS c FROM events GROUP BY 1")
def crosstab(r):
    rows = r.table("events").withColumn("g", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("user_id") % 3 + 1).cast("int")))
    return rows.groupBy("event_type").pivot("g", ["a", "b", "c"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM (SELECT sum(CASE WHEN t = 1 AND p = 1 THEN w ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN t = 0 AND p = 1 THEN w ELSE 0 END)::DOUBLE AS fp, sum(CASE WHEN t = 1 AND p = 0 THEN w ELSE 0 END)::DOUBLE AS fn FROM (SELECT quality AS t, CASE WHEN doc_id % 7 = 0 THEN 0 ELSE 1 END AS p, 1 + doc_id % 3 AS w FROM labels))")
def weighted_scores(r):
    rows = r.table("labels").select((F.col("quality") == 1).alias("truth"), (F.col("doc_id") % 7 != 0).alias("said"), (F.col("doc_id") % 3 + 1).cast("double").alias("weight"))
    out = evaluation.scores(rows)
    return out.select(*(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query("SELECT a.doc_id, a.quality AS first, b.quality AS second FROM labels a JOIN labels b ON a.doc_id = b.doc_id + 1 WHERE a.quality IS DISTINCT FROM b.quality")
def run_comparison(r):
    a = r.table("labels").select("doc_id", F.col("quality"))
    return evaluation.differing(a, a.withColumn("doc_id", F.col("doc_id") + 1), "doc_id", "quality")


_FUNNEL = ["length(text) > 200", "lang = 'en'", "source IN ('src1', 'src2', 'src3')", "doc_id % 2 = 0"]


@query("SELECT " + ", ".join(f"count(*) FILTER (WHERE {' AND '.join(_FUNNEL[: i + 1])}) AS step{i + 1}" for i in range(len(_FUNNEL))) + ", count(*) AS step0 FROM documents")
def catalogue_funnel(r):
    return evaluation.funnel(r.table("documents"), [F.expr(c) for c in _FUNNEL])


@query(
    "WITH f AS (SELECT p_partkey, p_size > 25 AS big, p_type = 'PROMO' AS promo, p_retailprice > 1000 AS dear, p_partkey % 2 = 0 AS even FROM part), u AS (SELECT p_partkey, dear, unnest(list_filter([CASE WHEN big THEN 'big' END, CASE WHEN promo THEN 'promo' END, CASE WHEN even THEN 'even' END, CASE WHEN big AND promo THEN 'big+promo' END, CASE WHEN big AND even THEN 'big+even' END, CASE WHEN promo AND even THEN 'promo+even' END], lambda x: x IS NOT NULL)) AS features FROM f) SELECT features, count(*) AS rows, count(*) FILTER (WHERE dear) AS right_ FROM u GROUP BY 1"
)
def feature_combinations(r):
    rows = r.table("part").select((F.col("p_size") > 25).alias("big"), (F.col("p_type") == "PROMO").alias("promo"), (F.col("p_partkey") % 2 == 0).alias("even"), (F.col("p_retailprice") > 1000).alias("dear"))
    return evaluation.combinations_of(rows, ["big", "promo", "even"], 2, F.col("dear")).withColumnRenamed("right", "right_")


@query("SELECT doc_id, contains(text, 'the') AND strpos(substr(text, strpos(text, 'the') + 3), 'of') > 0 AND length(text) > 0 AS found FROM documents")
def quote_check(r):
    return r.table("documents").select("doc_id", tx.pieces_in_order(F.col("text"), ["the", "of"]).alias("found"))


@query("SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE rtrim(regexp_replace(substr(text, 1, 80), ' [^ ]*$', ''), ' ,;:.') || '...' END AS shown FROM documents")
def preview_text(r):
    return r.table("documents").select("doc_id", tx.preview(F.col("text"), 80).alias("shown"))


@query("SELECT CAST(sum(occurrences) AS BIGINT) AS records, count(DISTINCT specieskey) AS species, min(year) AS first_year, max(year) AS last_year, CAST(sum(occurrences) FILTER (WHERE year IS NULL) AS BIGINT) AS no_year FROM hex", "hex")
def meta_figures(r):
    return r.hex.agg(F.sum("occurrences").alias("records"), F.countDistinct("specieskey").alias("species"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.sum(F.when(F.col("year").isNull(), F.col("occurrences"))).alias("no_year"))


@query("SELECT name, total FROM (SELECT 'records' AS name, (SELECT count(*) FROM celled) AS total UNION ALL SELECT 'hex', (SELECT CAST(sum(occurrences) AS BIGINT) FROM hex)) WHERE (SELECT count(*) FROM celled) <> (SELECT sum(occurrences) FROM hex)", "hex")
def check_totals(r):
    return checks.unequal_totals({"records": r.celled.agg(F.count("*").alias("n")), "hex": r.hex.agg(F.sum("occurrences").alias("n"))})


@query("SELECT coalesce(x.cell, y.cell) AS cell, x.records AS a, y.records AS b FROM (SELECT h3_r4 AS cell, count(*) AS records FROM celled WHERE h3_r4 IS NOT NULL AND l_quantity <> 7 GROUP BY 1) x FULL JOIN (SELECT h3_r4 AS cell, CAST(sum(occurrences) AS BIGINT) AS records FROM hex WHERE h3_r4 IS NOT NULL GROUP BY 1) y ON x.cell = y.cell WHERE x.records IS DISTINCT FROM y.records", "hex")
def check_hex_against_records(r):
    own = r.celled.where("h3_r4 is not null and l_quantity <> 7").groupBy(F.col("h3_r4").alias("cell")).agg(F.count("*").alias("records"))
    return checks.unequal_counts(own, species.hex_table(r.hex, 4), "cell", "records")


@query("SELECT lang, count(*) AS rows FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 1")
def check_domain(r):
    return checks.outside_domain(r.table("documents"), "lang", ["en", "fr"])


@query("SELECT doc_id FROM labels WHERE (quality = 1) <> (toxic = 0)")
def check_one_without_other(r):
    return checks.one_without_other(r.table("labels"), F.col("quality") == 1, F.col("toxic") == 0).select("doc_id")


@query("SELECT old_key AS specieskey FROM merge_keys WHERE old_key IN (SELECT kept_key FROM merge_keys)", "merge_keys")
def check_one_step(r):
    return checks.overlapping_keys(r.merge.select(F.col("kept_key").alias("specieskey")), "specieskey", r.merge, "old_key")


@query("SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ' 7'), doc_id) <= 5")
def stratified_sample(r):
    """The same rows in every run, by the order of a seeded digest."""
    return rel.hash_sample(r.table("documents").select("doc_id", "lang"), "doc_id", 5, 7, ["lang"])


@query()
def title_similarity(r):
    """difflib's ratio has no SQL; tests compare it with the library."""
    b = r.table("benchmark").select("item_id", F.col("text").alias("x"), F.expr("substring(text, 10)").alias("y"))
    return b.select("item_id", F.round(cat.similarity(F.col("x"), F.col("y")), 6).alias("ratio"))


@query()
def coordinates_in_text(r):
    """A parser with spans; tests hold it against written cases."""
    text = F.concat("text", F.lit(" 49° 30' 15\" N, 123° 15' W and 50.5 N 120.25 W"))
    return r.table("documents").select("doc_id", F.explode(cat.coordinates_in_text(text)).alias("c")).select("doc_id", "c.*")


@query()
def taxa_in_text(r):
    """Span claiming has no SQL; tests hold it against written cases."""
    text = F.concat(F.lit("Canis lupus and Ursus sp. near "), "text")
    return r.table("documents").select("doc_id", F.explode(cat.taxa_in_text(text, {"Canis", "Ursus"}, set(), {"lupus"})).alias("t")).select("doc_id", "t.name", "t.tier")


_STATUS = "CASE p_size % 4 WHEN 0 THEN 'Red' WHEN 1 THEN 'Blue' WHEN 2 THEN 'Yellow' ELSE 'No Status' END"


@query(
    f"""WITH e AS (SELECT p_partkey % 300 AS k, {_STATUS} AS status, p_name AS label, bool_or(p_size % 3 = 0) AS level, count(*) AS codes, CASE p_size % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 8 END AS place FROM part GROUP BY 1, 2, 3, 6)
    SELECT k AS gbif_species_key, string_agg(status || ': ' || label, '; ' ORDER BY NOT level, place, label) AS status_display, count(*) > 1 AS has_multiple, count(*) FILTER (WHERE level) >= 2 AS has_separate_bcsee_species, CAST(sum(codes) AS INTEGER) AS codes FROM e GROUP BY 1"""
)
def status_nesting(r):
    status = F.element_at(F.array(*map(F.lit, ["Red", "Blue", "Yellow", "No Status"])), (F.col("p_size") % 4 + 1).cast("int"))
    rows = r.table("part").select((F.col("p_partkey") % 300).alias("gbif_species_key"), F.lit("s").alias("species_name"), status.alias("status"), F.col("p_name").alias("scientific_label"), F.lit("GBIF").alias("name_source"), F.lit("").alias("common_label"), (F.col("p_size") % 3 == 0).alias("is_species_level"), F.lit(False).alias("is_gbif_synonym"), F.col("p_brand").alias("matched_species_key"), F.col("p_partkey").cast("string").alias("element_code"))
    return statuses.nested(rows).select("gbif_species_key", "status_display", "has_multiple", "has_separate_bcsee_species", F.size("element_codes").alias("codes"))


@query("SELECT p_partkey, (p_partkey % 4 <> 0 AND (p_size % 4 = 0 OR (p_size % 4 = 1 AND p_size % 3 = 0)) AND p_brand NOT IN ('Brand#1', 'Brand#2')) AS join_ok, (p_size % 4 = 2 OR p_brand IN ('Brand#1', 'Brand#2') OR (p_size % 4 = 1 AND p_size % 3 = 1)) AS needs_review FROM part")
def status_match_flags(r):
    pick = lambda values, c: F.element_at(F.array(*map(F.lit, values)), (c + 1).cast("int"))
    rows = r.table("part").select("p_partkey", F.when(F.col("p_partkey") % 4 != 0, "k").alias("gbif_species_key"), pick(["EXACT", "HIGHERRANK", "VARIANT", "NONE"], F.col("p_size") % 4).alias("gbif_match_type"), F.lit("SPECIES").alias("gbif_rank"), pick(["Subspecies", "Species", "Genus"], F.col("p_size") % 3).alias("classification_level"), F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), "MISAPPLIED").otherwise("ACCEPTED").alias("gbif_status"), F.lit("Aus bus").alias("scientific_name"))
    return statuses.with_flags(rows).select("p_partkey", "join_ok", "needs_review")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'x ' ELSE '' END || split_part(p_name, ' ', 1) || CASE WHEN p_size % 3 = 1 THEN ' x' ELSE '' END || ' ' || split_part(p_name, ' ', 2) || CASE WHEN p_type = 'PROMO' THEN ' var.' ELSE '' END || ' alba' AS written FROM part")
def written_names(r):
    canonical = F.concat("p_name", F.lit(" alba"))
    full = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("×"), canonical)).when(F.col("p_size") % 3 == 1, F.concat(F.lit("A × "), canonical)).otherwise(canonical)
    return r.table("part").select("p_partkey", statuses.written_name(canonical, full, F.when(F.col("p_type") == "PROMO", "VARIETY"), F.lit("Plantae")).alias("written"))


@query("SELECT doc_id, source, list_contains(flags, 'swapped') AS swapped, list_contains(flags, 'zero_width') AS zero_width, list_contains(flags, 'most_of_world') AS most_of_world FROM (SELECT doc_id, source, list_filter([CASE WHEN s > n OR (w > e AND NOT (w > 0 AND e < 0)) THEN 'swapped' END, CASE WHEN w = e OR s = n THEN 'zero_width' END, CASE WHEN (CASE WHEN w > 0 AND e < 0 THEN (e - w) + 360 ELSE abs(e - w) END) / 360 * abs(n - s) / 180 >= 0.5 THEN 'most_of_world' END], lambda x: x IS NOT NULL) AS flags FROM (SELECT doc_id, source, CAST(-180 + doc_id % 7 * 55 AS DOUBLE) AS w, CAST(180 - doc_id % 5 * 80 AS DOUBLE) AS e, CAST(-90 + doc_id % 3 * 40 AS DOUBLE) AS s, CAST(90 - doc_id % 11 * 14 AS DOUBLE) AS n FROM documents))")
def box_flags(r):
    k = F.col("doc_id")
    edges = [(k % 7 * 55 - 180).cast("double"), (k % 3 * 40 - 90).cast("double"), (F.lit(180) - k % 5 * 80).cast("double"), (F.lit(90) - k % 11 * 14).cast("double")]
    rows = r.table("documents").select("doc_id", "source", places.box_flags(*edges).alias("f"))
    return rows.select("doc_id", "source", *(F.array_contains("f", x).alias(x) for x in ("swapped", "zero_width", "most_of_world")))


@query("SELECT source, w, count(*) AS records FROM (SELECT DISTINCT doc_id, source, doc_id % 4 AS w FROM documents) GROUP BY 1, 2")
def box_multiplicity(r):
    box = F.struct((F.col("doc_id") % 4).alias("w"))
    out = places.box_multiplicity(r.table("documents").select(F.col("doc_id").alias("id"), "source", F.array(box, box).alias("boxes")))
    return out.select("source", F.col("box.w").alias("w"), "records")


@query("SELECT conv_id AS id, n AS boxes, t AS boxes_touching_bc, CASE WHEN t > 0 THEN CASE WHEN i = n THEN 'touches_bc_all_inside' ELSE 'touches_bc_partly' END WHEN f > 0 OR n > u OR u = 0 THEN 'send_to_llm' ELSE 'entirely_outside' END AS \"group\" FROM (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE turn % 5 <> 4) AS u, count(*) FILTER (WHERE conv_id % 3 = 0 AND role = 'user') AS t, count(*) FILTER (WHERE conv_id % 3 = 0 AND conv_id % 2 = 0) AS i, count(*) FILTER (WHERE conv_id % 7 = 1) AS f FROM conversations GROUP BY 1)")
def multi_box_groups(r):
    c = r.table("conversations")
    boxes = c.select(F.col("conv_id").alias("id"), (F.col("turn") % 5 != 4).alias("usable"), F.lit(False).alias("west_gt_east"), ((F.col("conv_id") % 3 == 0) & (F.col("role") == "user")).alias("touches"), (F.col("conv_id") % 6 == 0).alias("inside"), (F.col("conv_id") % 7 == 1).alias("flip_touches"))
    return places.roll_up(c.select(F.col("conv_id").alias("id")).distinct(), boxes).drop("problems")


@query("SELECT id, found AS places_found, CASE WHEN found = 0 THEN 'not_found' WHEN i > 0 AND found > i THEN 'both' WHEN i > 0 THEN 'in_bc_only' WHEN s > 0 THEN 'spans_bc_border' WHEN c > 0 THEN 'contains_bc' WHEN o > 0 THEN 'ocean_no_country' ELSE 'outside_bc_only' END AS category FROM (SELECT c_custkey AS id, count(o_orderkey) AS found, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS i, count(*) FILTER (WHERE o_orderkey % 5 = 1) AS s, count(*) FILTER (WHERE o_orderkey % 5 = 2) AS c, count(*) FILTER (WHERE o_orderkey % 5 = 3) AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey % 6 = 0 GROUP BY 1)")
def place_summary(r):
    kind = F.element_at(F.array(*map(F.lit, places.KINDS)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    found = r.table("orders").where("o_orderkey % 6 = 0").select(F.col("o_custkey").alias("id"), kind.alias("kind"))
    return places.summary(r.table("customer").select(F.col("c_custkey").alias("id")), found).select("id", "places_found", "category")


@query("SELECT l_returnflag AS list, g AS publisher_group, count(*) AS records, count(*) FILTER (WHERE u IS NULL) AS no_uncertainty, count(*) FILTER (WHERE u < 100) AS under_100_m, count(*) FILTER (WHERE u BETWEEN 100 AND 9999) AS to_10_km, count(*) FILTER (WHERE u >= 10000) AS from_10_km, count(*) FILTER (WHERE d <= 2) AS two_decimals, count(*) FILTER (WHERE d >= 4) AS four_decimals FROM (SELECT l_returnflag, unnest([l_linestatus, 'all']) AS g, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey * 7 % 20000 END AS u, l_linenumber AS d FROM lineitem) GROUP BY 1, 2")
def sensitive_report(r):
    li = r.table("lineitem")
    records = li.select(F.col("l_returnflag").alias("specieskey"), F.col("l_linestatus").alias("publisher_group"), F.when(F.col("l_linenumber") != 1, F.col("l_orderkey") * 7 % 20000).alias("uncertainty"), F.col("l_linenumber").alias("decimals"))
    listed = li.select(F.col("l_returnflag").alias("specieskey")).distinct().withColumn("list", F.col("specieskey"))
    return places.sensitive_publishers(records, listed)


@query("SELECT DISTINCT 'K' || p_partkey AS old_key, 'K' || (p_partkey // 10 * 10) AS kept_key, CASE WHEN p_partkey % 10 > 6 THEN 'not listed as a synonym' WHEN p_partkey % 10 IN (2, 5) THEN 'another author' WHEN p_partkey % 10 IN (3, 6) THEN 'ambiguous synonym' END AS problem FROM part WHERE p_partkey % 10 <> 0")
def synonym_rule(r):
    p = r.table("part").select("p_partkey", "p_name")
    key = lambda c: F.concat(F.lit("K"), c.cast("string"))
    kept = key(F.floor(F.col("p_partkey") / 10) * 10)
    own = p.select(key(F.col("p_partkey")).alias("id"), F.lit(None).cast("string").alias("parent_id"), F.lit("accepted").alias("status"), key(F.col("p_partkey")).alias("scientific_name"), F.lit("A.").alias("authorship"))
    digit = F.col("p_partkey") % 10
    listed = p.where("p_partkey % 10 between 1 and 6").select(F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("id"), kept.alias("parent_id"), F.when(digit.isin(3, 6), "ambiguous synonym").otherwise("synonym").alias("status"), key(F.col("p_partkey")).alias("scientific_name"), F.when(digit.isin(2, 5), "B.").otherwise("A.").alias("authorship"))
    merge = p.where("p_partkey % 10 <> 0").select(key(F.col("p_partkey")).alias("old_key"), kept.alias("kept_key"))
    return statuses.synonym_problem(merge, own.unionByName(listed))


@query("SELECT s_suppkey, (s_suppkey % 3 = 0 AND s_suppkey % 2 = 0) OR (s_suppkey % 3 = 1 AND s_suppkey % 2 = 1) AS same FROM supplier")
def authorship_match(r):
    """What is right stands in the SQL; tests hold the parser against written cases."""
    rows = r.table("supplier").select("s_suppkey", F.element_at(F.array(F.lit("(Mill.) Britton & Rose, 1920"), F.lit("L."), F.lit("Smith")), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("a"), F.element_at(F.array(F.lit("Rose & Britton"), F.lit("Linnaeus, 1758")), (F.col("s_suppkey") % 2 + 1).cast("int")).alias("b"))
    return rows.select("s_suppkey", authors.authors_match(F.col("a"), F.col("b")).alias("same"))


@query(f"SELECT s_suppkey, '{links.SEARCH}?checklistKey={links.CHECKLIST}&taxonKey=K' || s_suppkey || '&taxonKey=K%2F' || s_nationkey || '&geometry=POLYGON%28%28-125.000000+50.000000%2C-122.000000+50.000000%2C-122.000000+52.000000%2C-125.000000+52.000000%2C-125.000000+50.000000%29%29&occurrenceStatus=PRESENT&year=1990%2C2000' AS link FROM supplier")
def search_links(r):
    keys = F.array(F.concat(F.lit("K"), F.col("s_suppkey").cast("string")), F.concat(F.lit("K/"), F.col("s_nationkey").cast("string")))
    ring = [(-125.0, 50.0), (-125.0, 52.0), (-122.0, 52.0), (-122.0, 50.0)]
    return r.table("supplier").select("s_suppkey", links.search_link(keys, [ring], (1990, 2000)).alias("link"))
