"""Reports on runs of a labeller: failures, routes, scores on the same records, evidence, agreement, stability, hand decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.operators.relational import top_per_key

#: How a full context says so, the share of it that counts as near, and front-end groups by class.
FULL, NEAR = "filled the whole context", 0.9
NATIONAL_NOTE = "national plus outside"


def run_problems(results: DataFrame, room: int) -> DataFrame:
    """results (run, id, error, attempts, tokens) -> a row (run, id, problem) for each thing that went wrong."""
    none = F.lit(None).cast("string")
    seen = F.array(
        F.when(F.col("error").isNotNull(), "failed").otherwise(none),
        F.when(F.coalesce("attempts", F.lit(1)) > 1, "retried").otherwise(none),
        F.when(F.contains("error", F.lit(FULL)), "context_full").otherwise(none),
        F.when(F.coalesce("tokens", F.lit(0)) > NEAR * room, "near_limit").otherwise(none),
    )
    return results.select("run", "id", F.explode(F.array_compact(seen)).alias("problem"))


def run_limits(results: DataFrame) -> DataFrame:
    """The longest prompt of each run."""
    return results.groupBy("run").agg(F.max(F.coalesce("tokens", F.lit(0))).alias("most_tokens"))


def routes(rows: DataFrame, within: Column, ways: dict[str, Column]) -> DataFrame:
    """How many of the rows came by each way, the first that fits; one pass."""
    rest, parts = F.lit(True), []
    for name, ok in ways.items():
        ok = F.coalesce(ok, F.lit(False))
        parts.append(F.count_if(rest & ok).alias(name))
        rest = rest & ~ok
    return rows.where(within).agg(*parts)


def scores_by_run(labels: DataFrame, runs: DataFrame) -> DataFrame:
    """labels (id, truth, weight) and runs (run, id, said): weighted scores of each run on the labelled records alone."""
    w = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("weight"))), F.lit(0.0))
    truth, said = F.col("truth"), F.col("said")
    found = labels.join(runs, "id").groupBy("run").agg(F.count("*").alias("records"), w(truth & said).alias("tp"), w(~truth & said).alias("junk_kept"), w(truth & ~said).alias("real_lost"))
    keeps = F.col("tp") + F.col("junk_kept")
    return found.select("run", "records", F.try_divide("tp", keeps).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("real_lost")).alias("recall"), keeps.alias("keeps"), "junk_kept", "real_lost")


def evidence_totals(rows: DataFrame) -> DataFrame:
    """Of answered records (class, items, found, check): items given, found and not, and records that lack one."""
    answered = F.coalesce(F.col("class") != "", F.lit(False))
    some = lambda c: F.coalesce(F.sum(F.when(answered, F.col(c))), F.lit(0)).cast("bigint")
    lacking = F.count_if(answered & F.coalesce(F.contains("check", F.lit("not found")), F.lit(False)))
    return rows.agg(some("items").alias("items"), some("found").alias("found"), (some("items") - some("found")).alias("missing"), lacking.alias("records_missing"))


def order_outcome(first: Column, second: Column, answered: tuple[Column, Column], failed: Column) -> Column:
    """What two answers to one question, asked in two orders, come to; ids are null where none was chosen."""
    return (
        F.when(failed, "prompt_failed").when(~answered[0] | ~answered[1], "an_order_has_no_answer").when(first.isNull() & second.isNull(), "both_none")
        .when(first.eqNullSafe(second), "same_place").otherwise("orders_disagree")
    )


def places_with_words(places: DataFrame, norms: list[str]) -> DataFrame:
    """Places (geonameid, norm) one of whose names has a form as whole words: the shortest such name of each."""
    padded = F.concat(F.lit(" "), "norm", F.lit(" "))
    hit = places.where(reduce(lambda a, b: a | b, (F.contains(padded, F.lit(f" {n} ")) for n in norms), F.lit(False)))
    return top_per_key(hit, ["geonameid"], [F.length("norm"), F.col("norm")])


def stability(answers: DataFrame) -> DataFrame:
    """answers (id, place, value): whether all runs of a record said the same, and what they said, most frequent first."""
    counts = answers.groupBy("id", "value").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "first", "value")))
    parts = F.transform("l", lambda x: F.concat(x["value"], F.lit(" x"), (-x["o"]).cast("string")))
    said = F.when(F.size("l") == 1, F.concat(F.lit("same every time: "), F.col("l")[0]["value"])).otherwise(F.concat(F.lit("DIFFERED: "), F.array_join(parts, ", ")))
    return counts.groupBy("id").agg(listed.alias("l")).select("id", said.alias("said"))


def kept_ids(answers: DataFrame, hand: DataFrame) -> DataFrame:
    """answers (id, verdict) and hand decisions (id, kept): each id with how it came out. A hand decision holds whatever the verdict.

    way: kept, left, added or removed by hand, and two faults that must not occur: `unknown` (a decision
    for a record the run lacks) and `undecided` (a failed record without a decision).
    """
    rows = answers.select("id", "verdict").join(hand.select("id", F.col("kept").alias("by_hand")), "id", "full_outer")
    yes, hand_yes = F.col("verdict") == "yes", F.col("by_hand") == "yes"
    way = (
        F.when(F.col("verdict").isNull(), "unknown").when((F.col("verdict") == "failed") & F.col("by_hand").isNull(), "undecided")
        .when(F.coalesce(hand_yes, F.lit(False)), F.when(yes, "kept").otherwise("added")).when(F.col("by_hand") == "no", F.when(yes, "removed").otherwise("left")).when(yes, "kept").otherwise("left")
    )
    return rows.select("id", way.alias("way"))


def kept_by(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Ids that either run keeps, by who keeps them: both, only_<first> or only_<second>."""
    rows = first.select("id", F.lit(True).alias("a")).join(second.select("id", F.lit(True).alias("b")), "id", "full_outer")
    return rows.select("id", F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), f"only_{names[0]}").otherwise(f"only_{names[1]}").alias("group"))


def in_scope() -> Column:
    """Whether a record is about wild life, from facts about it; the first rule that fits decides.

    Columns: experimental_animals, extinct_only, topic, concerns_living_things, about_organisms_themselves,
    ecological_purpose_stated.
    """
    topic = F.col("topic")
    whole = (F.col("experimental_animals") == "yes") | (F.col("extinct_only") == "yes") | topic.isin("physical_environment", "human_health", "administrative")
    asked = F.when(topic == "forestry_agriculture_fisheries", F.col("about_organisms_themselves")).when(topic == "land_and_boundaries", F.col("ecological_purpose_stated")).otherwise("yes")
    out = F.coalesce(whole, F.lit(False)) | ~F.coalesce("concerns_living_things", F.lit(False))
    return F.when(~out & F.coalesce(asked == "yes", F.lit(False)), "yes").otherwise("no")


def with_hand_checks(records: DataFrame, checks: DataFrame) -> DataFrame:
    """records (id, copy_group, final_class, decided_by, note) after checks (id, checked, why), which hold for all copies of a record; before_hand says what was there.

    A copy without a check of its own takes that of the smallest id of its group.
    """
    own = records.join(checks, "id", "left")
    lead = top_per_key(own.where(F.col("checked").isNotNull() & (F.coalesce("copy_group", F.lit("")) != "")), ["copy_group"], [F.col("id")])
    lead = lead.select("copy_group", F.col("id").alias("via"), F.col("checked").alias("passed"))
    rows = own.join(lead, "copy_group", "left")
    note = F.when(F.col("checked").isNotNull(), F.col("why")).when(F.col("passed").isNotNull(), F.concat(F.lit("hand check applied via copy "), "via"))
    cls = F.coalesce("checked", "passed")
    return rows.select(
        "id", "copy_group", F.coalesce(cls, "final_class").alias("final_class"), F.when(cls.isNotNull(), "hand").otherwise(F.col("decided_by")).alias("decided_by"),
        F.concat_ws("; ", F.nullif("note", F.lit("")), note).alias("note"), F.when(cls.isNotNull(), F.format_string("%s (%s)", "final_class", "decided_by")).otherwise("").alias("before_hand"),
    )


def check_conflicts(records: DataFrame, checks: DataFrame) -> DataFrame:
    """Copy groups whose hand checks disagree; there must be none."""
    found = records.join(checks, "id").where(F.coalesce("copy_group", F.lit("")) != "")
    return found.groupBy("copy_group").agg(F.countDistinct("checked").alias("classes")).where("classes > 1")


def card_names(cards: DataFrame, names: DataFrame) -> DataFrame:
    """Cards (specieskey, species, col_name) against the name file (id, rank): a row (specieskey, problem) for each name that lacks, is of another rank or differs (by a subgenus alone, or by more)."""
    rows = cards.join(names.select(F.col("id").alias("specieskey"), F.lit(True).alias("there"), "rank"), "specieskey", "left")
    bare = F.regexp_replace("col_name", r" \([^)]*\)", "")
    none = F.lit(None).cast("string")
    problems = F.array(
        F.when(F.col("col_name").isNull(), "missing").otherwise(none),
        F.when(F.col("there") & ~F.col("rank").eqNullSafe(F.lit("species")), "rank").otherwise(none),
        F.when(F.col("col_name").isNotNull() & ~F.col("col_name").eqNullSafe(F.col("species")), F.when(bare == F.col("species"), "subgenus").otherwise("name")).otherwise(none),
    )
    return rows.select("specieskey", F.explode(F.array_compact(problems)).alias("problem"))


def manual_link_problems(matched: DataFrame, confirmed: DataFrame, linked: list[str]) -> DataFrame:
    """Names of the match table (name_norm, status, specieskey) that disagree with the confirmed list (name_norm, confirmed)."""
    rows = matched.join(confirmed, "name_norm", "left")
    by_hand, known = F.col("status") == "manual", F.col("confirmed").isNotNull()
    problem = (
        F.when(by_hand & ~known, "not confirmed").when(by_hand & ~F.col("confirmed").eqNullSafe(F.col("specieskey")), "another species")
        .when(~by_hand & ~F.col("status").isin(linked) & known, "not linked")
    )
    return rows.select("name_norm", problem.alias("problem")).where("problem is not null").distinct()


def image_problems(images: DataFrame, cards: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """Images (specieskey, identifier, license_code, license_rank) that are of no card, repeat a species, have no address or a rank that is not their licence's."""
    rank = F.element_at(F.create_map(*(F.lit(x) for k, v in ranks.items() for x in (k, v))), F.col("license_code"))
    rows = images.join(cards.select("specieskey", F.lit(True).alias("there")), "specieskey", "left").withColumn("times", F.count("*").over(Window.partitionBy("specieskey")))
    problem = (
        F.when(F.col("there").isNull(), "no card").when(F.col("times") > 1, "repeated").when(F.btrim(F.coalesce("identifier", F.lit(""))) == "", "no address").when(~rank.eqNullSafe(F.col("license_rank")), "rank")
    )
    return rows.select("specieskey", problem.alias("problem")).where("problem is not null")


def refuse_setting(name: str, value) -> None:
    """Stops where a setting asks for what is not there, rather than leave it out in silence."""
    if value is not None and str(value).strip():
        raise ValueError(f"{name}={value} asks for something that is not implemented")


def page_items(page: int, pages: int, around: int = 1) -> list[int | None]:
    """Page buttons: first, last and those around the current one, with None for a gap; always 2 * around + 5 of them if there are as many pages."""
    if pages <= 2 * around + 5:
        return list(range(1, pages + 1))
    low = min(max(page - around, 3), pages - 2 * around - 2)
    high = low + 2 * around
    return [1, 2 if low == 3 else None, *range(low, high + 1), pages - 1 if high == pages - 2 else None, pages]
