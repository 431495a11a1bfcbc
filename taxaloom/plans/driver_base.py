"""The driver's tables in the roles that the operators expect, and the same roles as DuckDB SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.operators import grid, species
from taxaloom.operators.relational import rewrite_key
from taxaloom.plans.shared import served

#: Both engines read these texts alike.
OCC = """
SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS gbifid,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'K' || CAST(l_partkey AS STRING) END AS specieskey,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE p_name || ' ' || CAST(l_partkey AS STRING) END AS species,
       CAST(nullif(year(l_shipdate), 1995) AS INTEGER) AS year,
       'D' || CAST(l_suppkey AS STRING) AS datasetkey,
       p_type AS kingdom, p_brand AS phylum,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'C' || CAST(p_size % 5 AS STRING) END AS class_,
       CASE WHEN p_size % 11 = 0 THEN NULL ELSE 'O' || CAST(p_size % 6 AS STRING) END AS order_,
       'F' || CAST(p_size % 9 AS STRING) AS family,
       CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_name END AS genus,
       CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST(48 AS DOUBLE) + CAST(l_orderkey % 1200 AS DOUBLE) / CAST(100 AS DOUBLE) END AS decimallatitude,
       CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE CAST(-139 AS DOUBLE) + CAST((l_partkey * 7 + l_linenumber) % 2500 AS DOUBLE) / CAST(100 AS DOUBLE) END AS decimallongitude,
       CASE WHEN l_quantity < 3 THEN 'ABSENT' WHEN l_quantity > 49 THEN NULL ELSE 'PRESENT' END AS occurrencestatus,
       CASE l_returnflag WHEN 'A' THEN 'FOSSIL_SPECIMEN' WHEN 'N' THEN 'HUMAN_OBSERVATION' ELSE 'PRESERVED_SPECIMEN' END AS basisofrecord,
       CASE WHEN l_linenumber = 7 THEN 'COUNTRY_COORDINATE_MISMATCH; OTHER' WHEN l_linenumber = 6 THEN 'OTHER' WHEN l_linenumber = 5 THEN NULL ELSE '' END AS issue_text,
       l_shipdate AS eventdate, l_quantity, l_linenumber, l_orderkey, l_partkey, l_suppkey
FROM lineitem JOIN part ON l_partkey = p_partkey
"""
MERGE = """
SELECT 'K' || CAST(p_partkey AS STRING) AS old_key, 'K' || CAST(p_partkey - 1 AS STRING) AS kept_key FROM part WHERE p_partkey % 50 = 1 AND (p_partkey - 1) % 97 <> 0 AND p_partkey % 97 <> 0
"""
KEYED = """
SELECT o.* EXCLUDE (specieskey), o.specieskey AS original_specieskey, coalesce(m.kept_key, o.specieskey) AS specieskey FROM occ o LEFT JOIN merge_keys m ON o.specieskey = m.old_key
"""
CELLED = "SELECT *, " + ", ".join(f"{grid.cell_sql('decimallatitude', 'decimallongitude', r)} AS h3_r{r}" for r in grid.AREAS) + " FROM keyed"
HEX = "SELECT specieskey, year, h3_r4, h3_r5, h3_r6, h3_r7, count(*) AS occurrences FROM celled GROUP BY ALL"
CARD = """
SELECT specieskey, any_value(kingdom) AS kingdom, any_value(phylum) AS phylum, any_value(class_) AS class_, any_value(order_) AS order_, any_value(family) AS family, any_value(genus) AS genus, min(species) AS col_name, count(*) AS record_count
FROM occ WHERE specieskey IS NOT NULL GROUP BY specieskey
"""
#: Documents as catalogue records.
RECORDS = """
SELECT 'rec/' || CAST(doc_id AS STRING) AS id, doc_id, split_part(text, '.', 1) AS title, text AS abstract, source,
       CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN '' ELSE CAST(1990 + doc_id % 30 AS STRING) || '-0' || CAST(1 + doc_id % 9 AS STRING) END AS issued,
       CASE CAST(doc_id % 4 AS INTEGER) WHEN 0 THEN 'bc_only' WHEN 1 THEN 'all_canada' WHEN 2 THEN 'global' ELSE 'unknown' END AS final_class,
       CASE CAST(doc_id % 3 AS INTEGER) WHEN 0 THEN 'bc_data' WHEN 1 THEN 'pending' ELSE 'hidden' END AS frontend_group, lang
FROM documents
"""
PARTS = {"occ": OCC, "merge_keys": MERGE, "keyed": KEYED, "celled": CELLED, "hex": HEX, "card": CARD, "records": RECORDS}
NEEDS = {"occ": [], "merge_keys": [], "keyed": ["occ", "merge_keys"], "celled": ["occ", "merge_keys", "keyed"], "hex": ["occ", "merge_keys", "keyed", "celled"], "card": ["occ"], "records": []}
#: search_norm as a DuckDB expression.
DUCK_NORM = r"trim(regexp_replace(replace(' ' || regexp_replace(regexp_replace(lower(strip_accents(coalesce({0}, ''))), '[''’‘`]', '', 'g'), '[^a-z0-9]+', ' ', 'g') || ' ', ' x ', ' '), ' +', ' ', 'g'))"


def sql(body: str, *parts: str) -> str:
    """A query over roles: the parts that it needs become common table expressions."""
    wanted: list[str] = []
    for p in parts:
        wanted += [x for x in [*NEEDS[p], p] if x not in wanted]
    return ("WITH " + ", ".join(f"{p} AS ({PARTS[p]})" for p in wanted) + " " if wanted else "") + body


class Roles:
    """The roles as DataFrames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _sql(self, text: str, *tables: str) -> DataFrame:
        return self.spark.sql(text.replace("FROM lineitem JOIN part", "FROM {lineitem} JOIN {part}").replace("FROM part ", "FROM {part} ").replace("FROM documents", "FROM {documents}"), **{t: self.table(t) for t in tables})

    @cached_property
    def occ(self) -> DataFrame:
        return self._sql(OCC, "lineitem", "part").withColumnsRenamed({"class_": "class", "order_": "order"})

    @cached_property
    def merge(self) -> DataFrame:
        return self._sql(MERGE, "part")

    @cached_property
    def keyed(self) -> DataFrame:
        return rewrite_key(self.occ, self.merge, "specieskey", "original_specieskey")

    @cached_property
    def celled(self) -> DataFrame:
        return species.with_cells(self.keyed)

    @property
    def built_hex(self) -> DataFrame:
        """The build of the table that maps and lists read."""
        return species.species_hex(self.celled)

    def _served(self, name: str, build, write) -> DataFrame:
        return served(self.spark, name, [f"{self.dir}/{t}.parquet" for t in ("lineitem", "part")], build, write)

    @cached_property
    def hex(self) -> DataFrame:
        return self._served("species_hex", lambda: self.built_hex, species.write_species_hex)

    @cached_property
    def card(self) -> DataFrame:
        return self._served("species_card", lambda: self.built_card, lambda df, path: df.write.option("compression", "zstd").parquet(path))

    @property
    def built_card(self) -> DataFrame:
        first = lambda c: F.first(c).alias(c)
        return self.occ.where("specieskey is not null").groupBy("specieskey").agg(*(first(c) for c in species.RANKS), F.min("species").alias("col_name"), F.count("*").alias("record_count"))

    @cached_property
    def records(self) -> DataFrame:
        return self._sql(RECORDS, "documents")
