"""Conservation statuses: what is asked for each name, which answers may be joined, and a species' nested entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Statuses in display order; those that are shown; answers a person must look at; levels below species; rank marks.
ORDER = ["Red", "Blue", "Yellow", "Exotic", "Not Reviewed", "Unknown", "Accidental", "No Status"]
SHOWN = ["Red", "Blue", "Yellow", "Exotic"]
REVIEW_STATUSES = ["AMBIGUOUS_SYNONYM", "MISAPPLIED"]
REVIEW_MATCHES = ["VARIANT", "CANONICAL", "AMBIGUOUS"]
BELOW_SPECIES = ["Population", "Subspecies", "Variety"]
PLACEHOLDER = r" sp\.\s*\S| aff\. | cf\. | nr\. |^\S+ \S+ complex\b"
MARKS = {"SUBSPECIES": "ssp.", "VARIETY": "var.", "FORM": "f."}
MARKED = ["Plantae", "Fungi"]


def question(hints: list[str]) -> Column:
    """The hints that are not blank, as `name=value` pairs; a blank hint is never sent."""
    pairs = [F.when(F.btrim(F.coalesce(F.col(h), F.lit("")), F.lit(" ")) != "", F.concat(F.lit(h + "="), F.btrim(h, F.lit(" ")))) for h in ["scientific_name", *hints]]
    return F.array_compact(F.array(*pairs))


def with_flags(rows: DataFrame) -> DataFrame:
    """rows with join_ok and needs_review; the answers themselves stay as they are."""
    has_key = F.col("gbif_species_key").isNotNull()
    match = F.coalesce("gbif_match_type", F.lit(""))
    above = (match == "HIGHERRANK") & (F.coalesce("gbif_rank", F.lit("")) == "SPECIES")
    level = F.coalesce("classification_level", F.lit(""))
    unclear = F.coalesce(F.col("gbif_status").isin(REVIEW_STATUSES), F.lit(False))
    placeholder = F.coalesce(F.col("scientific_name").rlike(PLACEHOLDER), F.lit(False))
    fits = (match == "EXACT") | (above & level.isin(BELOW_SPECIES))
    return rows.withColumns({"join_ok": has_key & fits & ~placeholder & ~unclear, "needs_review": match.isin(REVIEW_MATCHES) | unclear | (placeholder & has_key) | (above & (level == "Species"))})


def written_name(canonical: Column, full: Column, rank: Column, kingdom: Column) -> Column:
    """A short name as lists write it: the hybrid sign as x before or after the genus, the rank's mark before the last word of plants and fungi."""
    words = F.split(canonical, " ")
    hybrid = F.when(F.startswith(full, F.lit("×")), F.concat(F.array(F.lit("x")), words)).when(F.contains(full, F.lit("×")), F.concat(F.slice(words, 1, 1), F.array(F.lit("x")), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))))).otherwise(words)
    mark = F.lit(None).cast("string")
    for r, m in MARKS.items():
        mark = F.when(rank == r, F.lit(m)).otherwise(mark)
    n = F.size(hybrid)
    marked = F.when(mark.isNotNull() & kingdom.isin(MARKED) & (n >= 3), F.concat(F.slice(hybrid, F.lit(1), n - 1), F.array(mark), F.slice(hybrid, n, F.lit(1)))).otherwise(hybrid)
    return F.array_join(marked, " ")


def nested(entries: DataFrame) -> DataFrame:
    """One row for each species from rows (gbif_species_key, species_name, status, scientific_label, name_source, common_label, is_species_level, is_gbif_synonym, matched_species_key, element_code).

    Rows that show the same become one entry that keeps all codes and any flag. Entries come species
    level first, then by status, then by name. Where two or more are at species level none of them
    stands for the species; an entry with the species' own name is no synonym.
    """
    same = ["gbif_species_key", "species_name", "status", "scientific_label", "common_label"]
    merged = entries.groupBy(*same).agg(
        F.min_by("name_source", "element_code").alias("name_source"), F.bool_or("is_species_level").alias("is_species_level"), F.bool_or("is_gbif_synonym").alias("is_gbif_synonym"),
        F.array_sort(F.collect_set("matched_species_key")).alias("matched_species_keys"), F.array_sort(F.collect_list("element_code")).alias("element_codes"),
    )
    own = Window.partitionBy("gbif_species_key")
    merged = merged.withColumn("separate", F.count_if(F.col("is_species_level")).over(own) >= 2)
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ORDER)), F.col("status")), F.lit(0)), F.lit(len(ORDER) + 1))
    entry = F.struct(
        (~F.col("is_species_level")).alias("a"), place.alias("b"), F.col("scientific_label"), F.coalesce("common_label", F.lit("")).alias("common_label"), F.col("status"), F.col("name_source"),
        (F.col("is_species_level") & ~F.col("separate")).alias("is_species_level"), (F.col("is_gbif_synonym") & ~F.col("scientific_label").eqNullSafe(F.col("species_name"))).alias("is_gbif_synonym"),
        F.col("matched_species_keys"), F.col("element_codes"),
    )
    rows = merged.groupBy("gbif_species_key", "species_name", "separate").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    shown = F.array_distinct(F.filter(F.transform("e", lambda x: x["status"]), lambda s: s.isin(SHOWN)))
    line = lambda x: F.concat(x["status"], F.lit(": "), x["scientific_label"], F.when(x["name_source"] == "BCSEE", " (BCSEE name)").otherwise(""), F.when(x["common_label"] != "", F.concat(F.lit(" ["), x["common_label"], F.lit("]"))).otherwise(""))
    keep = ["status", "scientific_label", "name_source", "common_label", "is_species_level", "is_gbif_synonym", "matched_species_keys", "element_codes"]
    return rows.select(
        "gbif_species_key", "species_name", F.array_join(F.transform("e", line), "; ").alias("status_display"), (F.size("e") > 1).alias("has_multiple"), F.col("separate").alias("has_separate_bcsee_species"),
        shown.alias("statuses"), F.flatten(F.transform("e", lambda x: x["element_codes"])).alias("element_codes"), F.transform("e", lambda x: F.struct(*(x[k].alias(k) for k in keep))).alias("entries"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("e", lambda x: x["matched_species_keys"])))).alias("matched_species_keys"),
    )


def history(archives: DataFrame) -> DataFrame:
    """Element by snapshot year: the last row of each."""
    w = Window.partitionBy("element_code", "year").orderBy(F.desc("row"))
    return archives.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def synonym_problem(merge: DataFrame, names: DataFrame) -> DataFrame:
    """For each merge what is wrong with it by the checklist, or null: the old key's very name and author must be a plain synonym under the kept key."""
    n = names.select("id", "parent_id", "status", "scientific_name", F.coalesce("authorship", F.lit("")).alias("authorship"))
    old = n.select(F.col("id").alias("old_key"), F.col("scientific_name").alias("sn"), F.col("authorship").alias("sa"))
    kept = n.select(F.col("id").alias("kept_key"), F.lit(True).alias("has_kept"))
    listed = n.where(F.col("status").isin("synonym", "ambiguous synonym")).select(F.col("parent_id").alias("kept_key"), F.col("scientific_name").alias("sn"), F.col("authorship").alias("a"), F.col("status").alias("st"))
    rows = merge.join(old, "old_key", "left").join(kept, "kept_key", "left").join(listed, ["kept_key", "sn"], "left")
    exact = F.coalesce(F.col("a") == F.col("sa"), F.lit(False))
    found = rows.groupBy("old_key", "kept_key").agg(F.bool_and(F.col("sn").isNotNull() & F.coalesce("has_kept", F.lit(False))).alias("both"), F.bool_or(F.col("a").isNotNull()).alias("named"), F.bool_or(exact).alias("exact"), F.bool_or(exact & F.coalesce(F.col("st") == "synonym", F.lit(False))).alias("plain"))
    return found.select("old_key", "kept_key", F.when(~F.col("both"), "a key is not in the checklist").when(~F.col("named"), "not listed as a synonym").when(~F.col("exact"), "another author").when(~F.col("plain"), "ambiguous synonym").alias("problem"))
