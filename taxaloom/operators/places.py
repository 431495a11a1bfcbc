"""Reading what places say: mentions of the province, hints, kinds of candidates, boxes of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The province's names, neighbours, kinds of candidates.
NAME = r"(?i)British\s+Columbia|Colombie[-\s]Britannique"
SHORT = r"(?<![\w.]|[0-9] )B\.\s?C\.(?![A-Za-z])|(?<![\w.])C\.-B\.(?![A-Za-z])|(?<![\w/\-]|[0-9] )BC(?![\w])"
ELSEWHERE = r"\b(?:Alberta|Saskatchewan|Manitoba|Ontario|Qu[eé]bec|New Brunswick|Nova Scotia|Prince Edward Island|Newfoundland|Labrador|Yukon|Northwest Territories|Nunavut|Hudson Bay|Great Lakes|United States|U\.S\.A\.|USA|Mexico)\b"
CANADA = r"^\s*(?:Canada|CANADA|Canada \(.*\)|Canadian|Canadian waters)\s*$"
KINDS = ["in_bc", "spans_bc_border", "contains_bc", "ocean_no_country", "outside"]
NOT_DRAWN = ["swapped", "zero_width", "most_of_world"]
MOST_OF_WORLD = 0.5
CANADA_BOX, CANADA_MARGIN = (-141.0, 41.7, -52.6, 83.1), 0.5
ACCESS = "info:eu-repo/semantics/"


def mentions(text: Column, places: list[str]) -> Column:
    """The province's mentions in a text, each once: its name, its short form unless a year leads it, up to three places."""
    none = F.array().cast("array<string>")
    text = F.coalesce(text, F.lit(""))
    name = F.slice(F.regexp_extract_all(text, F.lit(NAME), F.lit(0)), 1, 1)
    short = F.slice(F.regexp_extract_all(text, F.lit(SHORT), F.lit(0)), 1, 1)
    listed = F.slice(F.regexp_extract_all(text, F.lit(r"\b(?:" + "|".join(rf"\Q{p}\E" for p in places) + r")\b"), F.lit(0)), 1, 3) if places else none
    return F.array_distinct(F.concat(name, short, listed))


def hint(places: Column, known: list[str]) -> Column:
    """Struct (hint, words) of a record's place names: bc, elsewhere, canada or nothing."""
    text = F.array_join(F.coalesce(places, F.array().cast("array<string>")), " ; ")
    own = mentions(text, known)
    away = F.array_distinct(F.regexp_extract_all(text, F.lit(ELSEWHERE), F.lit(0)))
    all_canada = (F.size(places) > 0) & F.forall(places, lambda p: p.rlike(CANADA))
    return F.struct(
        F.when(F.size(own) > 0, "bc").when(F.size(away) > 0, "elsewhere").when(F.coalesce(all_canada, F.lit(False)), "canada").otherwise("").alias("hint"),
        F.when(F.size(own) > 0, F.array_join(own, ", ")).when(F.size(away) > 0, F.array_join(away, ", ")).when(F.coalesce(all_canada, F.lit(False)), "Canada").otherwise("").alias("words"),
    )


def filled_in(in_bc: Column, other: Column, outside: Column, shares: Column, least: float = 0.5) -> Column:
    """An unclear answer is read as yes where a box lies mostly inside and nothing else is named."""
    big = F.exists(F.coalesce(shares, F.array().cast("array<double>")), lambda s: F.coalesce(s >= least, F.lit(False)))
    return F.when((in_bc == "unclear") & (other == "no") & (outside == "no") & big, "yes").otherwise(in_bc)


def best_rows(rows: DataFrame) -> DataFrame:
    """Of each place the row that matched it best: similarity, strength, kind of name."""
    kind = F.array_position(F.array(*map(F.lit, ["main", "ascii", "alternate", "hand"])), F.col("name_type"))
    key = F.coalesce(F.col("geonameid").cast("string"), F.concat(F.lit("hand:"), F.col("norm")))
    w = Window.partitionBy("id", key).orderBy(F.coalesce("similarity", F.lit(1.0)).desc(), F.col("strength"), kind, F.col("norm"))
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def ranked(places: DataFrame, n: int = 10) -> DataFrame:
    """The first n candidates of each question: hint, similarity, strength, population, country, id."""
    country = F.when(F.col("country_code") == "CA", 0).when(F.col("country_code") == "US", 1).otherwise(2)
    order = [F.coalesce("agrees", F.lit(False)).desc(), F.coalesce("similarity", F.lit(1.0)).desc(), F.col("strength"), F.coalesce("population", F.lit(0)).desc(), country, F.coalesce("geonameid", F.lit(0))]
    w = Window.partitionBy("id").orderBy(*order)
    return places.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def summary(asked: DataFrame, places: DataFrame) -> DataFrame:
    """How the candidates of each question (id) lie: counts by kind and a category."""
    counts = places.groupBy("id").agg(F.count("*").alias("places_found"), *(F.count_if(F.col("kind") == k).alias(k) for k in KINDS))
    out = asked.select("id").join(counts, "id", "left").na.fill(0)
    inside = F.col("in_bc") > 0
    category = F.when(F.col("places_found") == 0, "not_found").when(inside & (F.col("places_found") > F.col("in_bc")), "both").when(inside, "in_bc_only")
    for k in KINDS[1:4]:
        category = category.when(F.col(k) > 0, k)
    return out.withColumn("category", category.otherwise("outside_bc_only"))


def box_multiplicity(records: DataFrame) -> DataFrame:
    """Records of each source that share the very same box, each counted once: records (id, source, boxes)."""
    rows = records.dropDuplicates(["id"]).select("id", "source", F.explode("boxes").alias("box")).distinct()
    return rows.groupBy("source", "box").agg(F.count("*").alias("records"))


def box_flags(w: Column, s: Column, e: Column, n: Column) -> Column:
    """What is odd about a box: swapped edges, no width, most of the world."""
    across = (w > 0) & (e < 0)
    width = F.when(across, F.pmod(e - w, F.lit(360.0))).otherwise(F.abs(e - w))
    found = [F.when((s > n) | ((w > e) & ~across), "swapped"), F.when((w == e) | (s == n), "zero_width"), F.when(width / 360 * F.abs(n - s) / 180 >= MOST_OF_WORLD, "most_of_world")]
    west, south, east, north = CANADA_BOX
    near = lambda c, v: F.abs(c - v) <= CANADA_MARGIN
    extent = near(F.least(w, e), west) & near(F.greatest(w, e), east) & near(F.least(s, n), south) & near(F.greatest(s, n), north)
    found.append(F.when(extent & ~across, "matches_canada_extent"))
    return F.array_compact(F.array(*found))


def mappable(boxes: Column, points: Column) -> Column:
    """Whether there is anything to draw: a point, or a box without a flag that forbids it."""
    none = F.array(*map(F.lit, NOT_DRAWN))
    fit = F.exists(boxes, lambda b: ~F.arrays_overlap(box_flags(b["w"], b["s"], b["e"], b["n"]), none))
    return F.coalesce(fit, F.lit(False)) | F.coalesce(F.size(points) > 0, F.lit(False))


def roll_up(records: DataFrame, boxes: DataFrame) -> DataFrame:
    """Records with several boxes as one group each: boxes (id, usable, west_gt_east, touches, inside, flip_touches)."""
    flags = ["usable", "west_gt_east", "touches", "inside", "flip_touches"]
    per = boxes.groupBy("id").agg(F.count("*").alias("boxes"), *(F.count_if(F.col(f)).alias(f) for f in flags))
    r = records.select("id").join(per, "id", "left").na.fill(0)
    problems = F.array_compact(F.array(F.when(F.col("west_gt_east") > 0, "west > east"), F.when(F.col("boxes") > F.col("usable"), "flagged value"), F.when(F.col("usable") == F.col("west_gt_east"), "no usable box")))
    group = F.when(F.col("touches") > 0, F.when(F.col("inside") == F.col("boxes"), "touches_bc_all_inside").otherwise("touches_bc_partly")).when((F.size(problems) > 0) | (F.col("flip_touches") > 0), "send_to_llm").otherwise("entirely_outside")
    return r.select("id", "boxes", F.col("touches").alias("boxes_touching_bc"), group.alias("group"), F.array_join(problems, "; ").alias("problems"))


def record_access(licences: Column) -> Column:
    """open, restricted or null, from a record's unnamed access rights."""
    said = lambda code: F.exists(licences, lambda x: F.coalesce((F.coalesce(x["name"], F.lit("")) == "") & (x["uri"] == ACCESS + code), F.lit(False)))
    return F.when(said("openAccess"), "open").when(said("restrictedAccess"), "restricted")


def access_agrees(record: Column, checked: Column, open_values: list[str]) -> Column:
    """Whether a checked access agrees with the record's; null without both."""
    return F.when(record.isNotNull() & checked.isNotNull(), checked.isin(open_values) == (record == "open"))


def mentions_first(fields: dict[str, Column], quote: str) -> Column:
    """The name of the first field that holds a quoted text."""
    return reduce(lambda out, kv: F.when(F.contains(F.lower(F.coalesce(kv[1], F.lit(""))), F.lit(quote.lower())), F.lit(kv[0])).otherwise(out), reversed(list(fields.items())), F.lit(None).cast("string"))


def sensitive_publishers(records: DataFrame, lists: DataFrame) -> DataFrame:
    """Listed species' records by publisher group, with a row for all: how many are generalised or coarse. lists (specieskey, list)."""
    rows = records.join(lists, "specieskey").select("list", F.explode(F.array("publisher_group", F.lit("all"))).alias("publisher_group"), "uncertainty", "decimals")
    some = lambda ok: F.count_if(F.coalesce(ok, F.lit(False))).alias
    return rows.groupBy("list", "publisher_group").agg(
        F.count("*").alias("records"), some(F.col("uncertainty").isNull())("no_uncertainty"), some(F.col("uncertainty") < 100)("under_100_m"), some(F.col("uncertainty").between(100, 9999))("to_10_km"),
        some(F.col("uncertainty") >= 10000)("from_10_km"), some(F.col("decimals") <= 2)("two_decimals"), some(F.col("decimals") >= 4)("four_decimals"),
    )
