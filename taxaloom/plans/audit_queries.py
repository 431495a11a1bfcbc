"""Queries over the driver's tables for audits of labelling runs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import audits
from taxaloom.operators import catalogue as cat
from taxaloom.plans.driver_queries import ORACLE_SQL, QUERIES, query

__all__ = ["ORACLE_SQL", "QUERIES"]

_RESULTS = "(SELECT 'r' || turn AS run, conv_id AS id, CASE conv_id % 7 WHEN 0 THEN 'timeout' WHEN 1 THEN 'it filled the whole context here' END AS error, CASE WHEN conv_id % 5 = 0 THEN 2 END AS attempts, length(text) AS tokens FROM conversations)"


def _results(r):
    k = F.col("conv_id") % 7
    return r.table("conversations").select(
        F.concat(F.lit("r"), F.col("turn").cast("string")).alias("run"), F.col("conv_id").alias("id"), F.when(k == 0, "timeout").when(k == 1, "it filled the whole context here").alias("error"),
        F.when(F.col("conv_id") % 5 == 0, 2).alias("attempts"), F.length("text").cast("bigint").alias("tokens"),
    )


@query(f"SELECT run, id, unnest(list_filter([CASE WHEN error IS NOT NULL THEN 'failed' END, CASE WHEN attempts > 1 THEN 'retried' END, CASE WHEN contains(error, 'filled the whole context') THEN 'context_full' END, CASE WHEN coalesce(tokens, 0) > 0.9 * 400 THEN 'near_limit' END], lambda x: x IS NOT NULL)) AS problem FROM {_RESULTS}")
def run_problems(r):
    return audits.run_problems(_results(r), 400)


@query(f"SELECT run, max(coalesce(tokens, 0)) AS most_tokens FROM {_RESULTS} GROUP BY 1")
def run_limits(r):
    return audits.run_limits(_results(r))


@query("SELECT count(*) FILTER (WHERE doc_id % 3 = 0) AS via_bc, count(*) FILTER (WHERE doc_id % 3 <> 0) AS via_canada FROM documents WHERE lang = 'en'")
def route_split(r):
    return audits.routes(r.table("documents"), F.col("lang") == "en", {"via_bc": F.col("doc_id") % 3 == 0, "via_canada": F.lit(True)})


@query(
    """SELECT run, count(*) AS records, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, tp + fp AS keeps, fp AS junk_kept, fn AS real_lost FROM (
    SELECT run, count(*) AS n, coalesce(sum(w) FILTER (WHERE t AND s), 0) AS tp, coalesce(sum(w) FILTER (WHERE NOT t AND s), 0) AS fp, coalesce(sum(w) FILTER (WHERE t AND NOT s), 0) AS fn
    FROM (SELECT doc_id, quality = 1 AS t, CAST(1 + doc_id % 4 AS DOUBLE) AS w FROM labels WHERE quality IS NOT NULL) JOIN (SELECT doc_id, 'a' AS run, lang = 'en' AS s FROM documents WHERE lang IS NOT NULL UNION ALL SELECT doc_id, 'b', n_chars > 900 FROM documents) USING (doc_id) GROUP BY 1)""".replace("count(*) AS records", "n AS records")
)
def scores_by_run(r):
    docs = r.table("documents").withColumnRenamed("doc_id", "id")
    runs = docs.where("lang is not null").select(F.lit("a").alias("run"), "id", (F.col("lang") == "en").alias("said")).unionByName(docs.select(F.lit("b").alias("run"), "id", (F.col("n_chars") > 900).alias("said")))
    labels = r.table("labels").where("quality is not null").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("truth"), (F.col("doc_id") % 4 + 1).cast("double").alias("weight"))
    return audits.scores_by_run(labels, runs)


@query("SELECT coalesce(sum(n_chars) FILTER (WHERE lang <> ''), 0)::BIGINT AS items, coalesce(sum(n_chars // 2) FILTER (WHERE lang <> ''), 0)::BIGINT AS found, coalesce(sum(n_chars - n_chars // 2) FILTER (WHERE lang <> ''), 0)::BIGINT AS missing, count(*) FILTER (WHERE lang <> '' AND doc_id % 6 = 0) AS records_missing FROM documents")
def evidence_totals(r):
    docs = r.table("documents")
    return audits.evidence_totals(docs.select(F.col("lang").alias("class"), F.col("n_chars").alias("items"), F.floor(F.col("n_chars") / 2).alias("found"), F.when(F.col("doc_id") % 6 == 0, "1 not found").alias("check")))


@query("SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'prompt_failed' WHEN doc_id % 7 = 0 OR doc_id % 13 = 0 THEN 'an_order_has_no_answer' WHEN doc_id % 3 = 0 AND doc_id % 4 = 0 THEN 'both_none' WHEN doc_id % 3 <> 0 AND doc_id % 4 <> 0 AND doc_id % 3 = doc_id % 4 THEN 'same_place' ELSE 'orders_disagree' END AS outcome FROM documents")
def order_outcome(r):
    k = F.col("doc_id")
    first, second = F.nullif(k % 3, F.lit(0)), F.nullif(k % 4, F.lit(0))
    return r.table("documents").select("doc_id", audits.order_outcome(first, second, (k % 7 != 0, k % 13 != 0), k % 11 == 0).alias("outcome"))


@query("SELECT p_size AS geonameid, p_name AS norm FROM part WHERE ' ' || p_name || ' ' LIKE '% ring %' OR ' ' || p_name || ' ' LIKE '% blue %' QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY length(p_name), p_name) = 1")
def places_with_words(r):
    places = r.table("part").select(F.col("p_size").alias("geonameid"), F.col("p_name").alias("norm")).distinct()
    return audits.places_with_words(places, ["ring", "blue"])


@query("SELECT user_id AS id, CASE WHEN count(*) = 1 THEN 'same every time: ' || any_value(event_type) ELSE 'DIFFERED: ' || string_agg(event_type || ' x' || n, ', ' ORDER BY n DESC, f) END AS said FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2) GROUP BY 1")
def answer_stability(r):
    return audits.stability(r.table("events").select(F.col("user_id").alias("id"), F.col("event_id").alias("place"), F.col("event_type").alias("value")))


@query("SELECT coalesce(a.doc_id, h.doc_id) AS id, CASE WHEN v IS NULL THEN 'unknown' WHEN v = 'failed' AND k IS NULL THEN 'undecided' WHEN k = 'yes' AND v = 'yes' THEN 'kept' WHEN k = 'yes' THEN 'added' WHEN k = 'no' AND v = 'yes' THEN 'removed' WHEN k = 'no' THEN 'left' WHEN v = 'yes' THEN 'kept' ELSE 'left' END AS way FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'failed' END AS v FROM documents) a FULL JOIN (SELECT doc_id + 5 AS doc_id, CASE WHEN doc_id % 2 = 0 THEN 'yes' ELSE 'no' END AS k FROM labels) h ON a.doc_id = h.doc_id")
def kept_ids(r):
    k = F.col("doc_id") % 3
    answers = r.table("documents").select(F.col("doc_id").alias("id"), F.when(k == 0, "yes").when(k == 1, "no").otherwise("failed").alias("verdict"))
    hand = r.table("labels").select((F.col("doc_id") + 5).alias("id"), F.when(F.col("doc_id") % 2 == 0, "yes").otherwise("no").alias("kept"))
    return audits.kept_ids(answers, hand)


@query("SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'only_b' WHEN b.id IS NULL THEN 'only_a' ELSE 'both' END AS \"group\" FROM (SELECT doc_id AS id FROM documents) a FULL JOIN (SELECT doc_id + 40 AS id FROM documents) b ON a.id = b.id")
def kept_by(r):
    ids = r.table("documents").select(F.col("doc_id").alias("id"))
    return audits.kept_by(ids, ids.select((F.col("id") + 40).alias("id")), ("a", "b"))


_TOPICS = ["physical_environment", "human_health", "administrative", "forestry_agriculture_fisheries", "land_and_boundaries", "species"]


@query(
    f"""SELECT doc_id, CASE WHEN a = 'yes' OR x = 'yes' OR t IN ('physical_environment', 'human_health', 'administrative') THEN 'no' WHEN NOT coalesce(l, false) THEN 'no' WHEN t = 'forestry_agriculture_fisheries' THEN CASE WHEN o = 'yes' THEN 'yes' ELSE 'no' END WHEN t = 'land_and_boundaries' THEN CASE WHEN e = 'yes' THEN 'yes' ELSE 'no' END ELSE 'yes' END AS scope FROM (
    SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'yes' END AS a, CASE WHEN doc_id % 19 = 0 THEN 'yes' ELSE 'no' END AS x, {_TOPICS!r}[doc_id % 6 + 1] AS t, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS l, CASE doc_id % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS o, CASE WHEN doc_id % 7 < 4 THEN 'yes' ELSE 'no' END AS e FROM documents)"""
)
def scope_decision(r):
    k = F.col("doc_id")
    facts = r.table("documents").select(
        "doc_id", F.when(k % 17 == 0, "yes").alias("experimental_animals"), F.when(k % 19 == 0, "yes").otherwise("no").alias("extinct_only"), F.element_at(F.array(*map(F.lit, _TOPICS)), (k % 6 + 1).cast("int")).alias("topic"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.lit(False)).otherwise(F.lit(True)).alias("concerns_living_things"), F.when(k % 3 == 0, "yes").when(k % 3 == 1, "no").alias("about_organisms_themselves"), F.when(k % 7 < 4, "yes").otherwise("no").alias("ecological_purpose_stated"),
    )
    return facts.select("doc_id", audits.in_scope().alias("scope"))


_GROUPED = "(SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'g' || (doc_id // 8) END AS copy_group, 'c' || (doc_id % 3) AS final_class, 'rule' AS decided_by, CASE WHEN doc_id % 2 = 0 THEN 'seen' ELSE '' END AS note FROM documents)"
_CHECKED = "(SELECT doc_id AS id, 'h' || (doc_id // 8 % 2) AS checked, 'looked at' AS why FROM documents WHERE doc_id % 9 = 0)"


def _grouped(r):
    k = F.col("doc_id")
    docs = r.table("documents")
    tag = lambda x, c: F.concat(F.lit(x), c.cast("string"))
    rows = docs.select(k.alias("id"), F.when(k % 4 == 0, "").otherwise(tag("g", F.floor(k / 8))).alias("copy_group"), tag("c", k % 3).alias("final_class"), F.lit("rule").alias("decided_by"), F.when(k % 2 == 0, "seen").otherwise("").alias("note"))
    return rows, docs.where("doc_id % 9 = 0").select(k.alias("id"), tag("h", F.floor(k / 8) % 2).alias("checked"), F.lit("looked at").alias("why"))


@query(
    f"""SELECT r.id, r.copy_group, coalesce(c.checked, v.checked, r.final_class) AS final_class, CASE WHEN coalesce(c.checked, v.checked) IS NULL THEN r.decided_by ELSE 'hand' END AS decided_by,
    concat_ws('; ', nullif(r.note, ''), CASE WHEN c.id IS NOT NULL THEN c.why WHEN v.id IS NOT NULL THEN 'hand check applied via copy ' || v.id END) AS note, CASE WHEN coalesce(c.checked, v.checked) IS NULL THEN '' ELSE r.final_class || ' (' || r.decided_by || ')' END AS before_hand
    FROM {_GROUPED} r LEFT JOIN {_CHECKED} c ON c.id = r.id LEFT JOIN (SELECT g.copy_group, arg_min(h.id, h.id) AS id, arg_min(h.checked, h.id) AS checked FROM {_CHECKED} h JOIN {_GROUPED} g ON g.id = h.id WHERE g.copy_group <> '' GROUP BY 1) v ON v.copy_group = r.copy_group"""
)
def hand_checks(r):
    return audits.with_hand_checks(*_grouped(r))


@query(f"SELECT copy_group, count(DISTINCT checked) AS classes FROM (SELECT g.copy_group, 'h' || (h.id % 2) AS checked FROM (SELECT id FROM {_GROUPED} WHERE id % 3 = 0) h JOIN {_GROUPED} g ON g.id = h.id WHERE g.copy_group <> '') GROUP BY 1 HAVING count(DISTINCT checked) > 1")
def hand_check_conflicts(r):
    rows, _ = _grouped(r)
    return audits.check_conflicts(rows, rows.where("id % 3 = 0").select("id", F.concat(F.lit("h"), (F.col("id") % 2).cast("string")).alias("checked")))


@query(
    """SELECT specieskey, unnest(list_filter([CASE WHEN col_name IS NULL THEN 'missing' END, CASE WHEN there AND rank IS DISTINCT FROM 'species' THEN 'rank' END, CASE WHEN col_name IS NOT NULL AND col_name IS DISTINCT FROM species THEN CASE WHEN regexp_replace(col_name, ' \\([^)]*\\)', '', 'g') = species THEN 'subgenus' ELSE 'name' END END], lambda x: x IS NOT NULL)) AS problem FROM (
    SELECT p_partkey AS specieskey, p_name AS species, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN replace(p_name, ' ', ' (Sub) ') WHEN 2 THEN p_name || ' x' ELSE p_name END AS col_name, p_partkey % 3 <> 0 AS there, CASE WHEN p_partkey % 7 = 0 THEN 'genus' ELSE 'species' END AS rank FROM part)"""
)
def name_file_check(r):
    k = F.col("p_partkey")
    p = r.table("part")
    named = F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, F.replace("p_name", F.lit(" "), F.lit(" (Sub) "))).when(k % 5 == 2, F.concat("p_name", F.lit(" x"))).otherwise(F.col("p_name"))
    cards = p.select(k.alias("specieskey"), F.col("p_name").alias("species"), named.alias("col_name"))
    return audits.card_names(cards, p.where("p_partkey % 3 <> 0").select(k.alias("id"), F.when(k % 7 == 0, "genus").otherwise("species").alias("rank")))


@query("SELECT DISTINCT name_norm, problem FROM (SELECT p_partkey AS name_norm, CASE WHEN p_size % 3 = 0 AND p_partkey % 4 <> 0 THEN 'not confirmed' WHEN p_size % 3 = 0 AND p_size % 5 = 0 THEN 'another species' WHEN p_size % 3 = 1 AND p_partkey % 4 = 0 THEN 'not linked' END AS problem FROM part) WHERE problem IS NOT NULL")
def manual_links_check(r):
    p = r.table("part")
    status = F.element_at(F.array(*map(F.lit, ["manual", "unmatched", "scientific"])), (F.col("p_size") % 3 + 1).cast("int"))
    matched = p.select(F.col("p_partkey").alias("name_norm"), status.alias("status"), F.when(F.col("p_size") % 5 == 0, -1).otherwise(F.col("p_partkey")).alias("specieskey"))
    return audits.manual_link_problems(matched, p.where("p_partkey % 4 = 0").select(F.col("p_partkey").alias("name_norm"), F.col("p_partkey").alias("confirmed")), ["scientific"])


@query("SELECT p_partkey AS specieskey, CASE WHEN p_partkey % 10 = 0 THEN 'no card' WHEN p_partkey % 10 = 1 THEN 'no address' ELSE 'rank' END AS problem FROM part WHERE p_partkey % 10 IN (0, 1) OR p_size % 2 = 0")
def image_table_check(r):
    p = r.table("part")
    images = p.select(F.col("p_partkey").alias("specieskey"), F.when(F.col("p_partkey") % 10 == 1, " ").otherwise("u").alias("identifier"), F.lit("CC_BY_4_0").alias("license_code"), F.when(F.col("p_size") % 2 == 0, 9).otherwise(2).alias("license_rank"))
    return audits.image_problems(images, p.where("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("specieskey")), {"CC_BY_4_0": 2})


_LISTS = {"genera": ["The", "This", "Vulpes", "Red"], "families": ["And"], "higher": ["But"], "epithets": ["and", "the", "vulpes"], "species": ["The quick", "Vulpes vulpes"]}

@query()
def taxa_by_tier(r):
    """Whole texts; a test holds every row against a slow version."""
    frames = {k: r.spark.createDataFrame([(x,) for x in v], "name string") for k, v in _LISTS.items()}
    return cat.taxa_tiers(r.table("documents").select(F.col("doc_id").alias("id"), "text"), frames)
