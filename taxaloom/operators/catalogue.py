"""Catalogue records: versions, copies, votes, classes, names, places and linkage."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.functions import text as tx
from taxaloom.functions.dates import try_time
from taxaloom.operators import coordinates as coords
from taxaloom.operators.relational import connected_components, top_per_key

#: Box classes from the most to the least inside, what they vote for and their notes.
BOX_ORDER = ["inside", "bc_wide", "mostly_bc", "partly_bc", "huge", "outside"]
BOX_VOTES = {"inside": "bc", "bc_wide": "bc", "outside": "not_bc"}
RANK_WORDS = ["sp", "spp"]
FIELDS = ["col_name", "english_name", "merged_name", "bcsee_scientific_label", "bcsee_entry_english_name"]
SCIENTIFIC = ["col_name", "merged_name", "bcsee_scientific_label"]
MATCHED = [*SCIENTIFIC, "english_name", "bcsee_entry_english_name"]
#: Letters without an accent to take off.
SPECIAL = [("ø", "o"), ("Ø", "O"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ß", "ss"), ("ł", "l"), ("Ł", "L"), ("đ", "d"), ("Đ", "D"), ("þ", "th"), ("Þ", "Th"), ("ð", "d"), ("Ð", "D"), ("ı", "i")]
DIRECTIONS = ["north", "south", "east", "west", "northern", "southern", "eastern", "western", "central", "upper", "lower"]


def version_marks(records: DataFrame) -> DataFrame:
    """Old versions: named in another record's `obsoletes` (an array), or not the one kept of their series.

    Of a series that one is kept which no record names, then the latest upload, then the latest change,
    then the greatest id.
    """
    ids = records.select(F.col("id").alias("older"))
    named = records.select(F.col("id").alias("newer"), F.explode("obsoletes").alias("older")).where("older <> newer").join(ids, "older", "left_semi")
    replaced = named.groupBy(F.col("older").alias("id")).agg(F.array_join(F.array_sort(F.collect_set("newer")), " ").alias("replaced_by"))
    rows = records.join(replaced, "id", "left")
    in_series = F.col("seriesId").isNotNull() & (F.col("seriesId") != "")
    order = [F.col("replaced_by").isNull().desc(), F.desc_nulls_last(try_time(F.col("dateUploaded"))), F.desc_nulls_last(try_time(F.col("dateModified"))), F.desc("id")]
    keeper = F.first("id").over(Window.partitionBy("seriesId").orderBy(*order))
    # records without a series, which may be most, never meet in one task
    rows = rows.where(in_series).withColumn("keeper", keeper).unionByName(rows.where(~F.coalesce(in_series, F.lit(False))).withColumn("keeper", F.lit(None).cast(dict(records.dtypes)["id"])))
    a, b = F.col("replaced_by").isNotNull(), F.coalesce(F.col("keeper") != F.col("id"), F.lit(False))
    reason = F.concat_ws("+", F.when(a, "replaced"), F.when(b, "older_in_series"))
    return rows.select(*records.columns, F.when(a | b, "old").otherwise("latest").alias("version_status"), reason.alias("old_reason"), F.when(a, F.col("replaced_by")).when(b, F.col("keeper")).alias("newer_id"))


def latest_per_id(records: DataFrame, stamp: str, row: str) -> DataFrame:
    """The latest row of each id, the first one on a tie."""
    return top_per_key(records, ["id"], [F.desc_nulls_last(stamp), F.col(row)])


def copy_groups(records: DataFrame) -> DataFrame:
    """Records that share the UUID at their id's end, or title and abstract, are copies: id and copy_group (its smallest id)."""
    by_uuid = records.select("id", F.concat(F.lit("u"), tx.trailing_uuid(F.col("id"))).alias("k"))
    words = F.concat_ws("\u0001", tx.normal_title(F.col("title")), tx.normal_title(F.col("abstract")))
    by_text = records.select("id", F.when(tx.normal_title(F.col("title")) != "", F.concat(F.lit("t"), F.sha2(words, 256))).alias("k"))
    keys = by_uuid.unionByName(by_text).where("k is not null")
    # a star to each key's smallest id: links grow with the records, not with the pairs of a key
    heads = keys.groupBy("k").agg(F.min("id").alias("a"))
    links = keys.join(heads, "k").select("a", F.col("id").alias("b")).where("a <> b")
    comps = connected_components(links)
    return records.select("id").join(comps.select(F.col("node").alias("id"), F.col("comp").alias("copy_group")), "id", "left").select("id", F.coalesce("copy_group", "id").alias("copy_group"))


def shown_copies(records: DataFrame, groups: list[str]) -> DataFrame:
    """Of each copy group the record that is shown: best class group, newest issue, newest stamp, smallest id; with the number of copies."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, groups)), F.col("frontend_group")), F.lit(0)), F.lit(len(groups) + 1))
    order = [place, F.desc_nulls_last(F.nullif("issued", F.lit(""))), F.desc_nulls_last("datestamp"), F.col("id")]
    counted = records.withColumn("copy_count", F.count("*").over(Window.partitionBy("copy_group")))
    return top_per_key(counted, ["copy_group"], order)


def group_conflicts(records: DataFrame, value: str) -> DataFrame:
    """Copy groups whose members have different values."""
    found = records.groupBy("copy_group").agg(F.countDistinct(value).alias("n"), F.array_join(F.array_sort(F.collect_set(value)), ",").alias("found"))
    return found.where("n > 1")


def combine_votes(box_classes: Column, point_classes: Column, source_kind: Column) -> Column:
    """Struct (bc_class, decided_by) from an array of box classes, an array of point classes and the catalogue's kind.

    Votes that agree decide. Votes that differ, none at all, or the catalogue alone beside a huge box
    leave the record open.
    """
    none = F.array().cast("array<string>")
    boxes, points = F.coalesce(box_classes, none), F.coalesce(point_classes, none)
    has = F.array_contains
    vote = lambda rule, ok, kind: F.when(F.coalesce(ok, F.lit(False)), F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("kind")))
    votes = F.array_compact(
        F.array(
            *(vote("box", has(boxes, c), k) for c, k in BOX_VOTES.items()),
            vote("point", has(points, "inside"), "bc"), vote("point", has(points, "outside"), "not_bc"),
            vote("source", source_kind == "bc", "bc"), vote("source", source_kind == "not_bc", "not_bc"),
        )
    )
    rules, kinds = F.array_distinct(F.transform(votes, lambda v: v["rule"])), F.array_distinct(F.transform(votes, lambda v: v["kind"]))
    alone = (F.size(rules) == 1) & has(rules, "source") & has(boxes, "huge")
    return F.struct(
        F.when(alone | (F.size(kinds) != 1), "needs_llm").otherwise(F.get(kinds, F.lit(0))).alias("bc_class"),
        F.when(alone | (F.size(votes) == 0), "none").otherwise(F.array_join(rules, "+")).alias("decided_by"),
    )


def best_box(box_classes: Column) -> Column:
    """The box class nearest to the inside."""
    return F.get(F.filter(F.array(*map(F.lit, BOX_ORDER)), lambda c: F.array_contains(box_classes, c)), F.lit(0))


def class_of(in_bc: Column, other_canada: Column, outside: Column, canada_wide: Column, worldwide: Column) -> Column:
    """The decision table over a model's facts; the first row that fits."""
    yes = lambda c: c == "yes"
    return (
        F.when(yes(worldwide), "global")
        .when(yes(outside) & (yes(in_bc) | yes(canada_wide)), "bc_and_outside_canada")
        .when(yes(canada_wide), "all_canada")
        .when(yes(in_bc) & yes(other_canada), "canada_incl_bc")
        .when(yes(in_bc), "bc_only")
        .when(in_bc == "no", "elsewhere")
        .otherwise("unknown")
    )


def final_class(rule_class: Column, model_class: Column, source: Column, own_catalogues: list[str], forced: list[str]) -> Column:
    """Struct (final_class, decided_by): a rule decides before the model; records of own catalogues are never put elsewhere by it."""
    own = source.isin(own_catalogues) & model_class.isin(forced)
    by_rule = rule_class.isin("bc", "not_bc")
    return F.struct(
        F.when(by_rule, F.when(rule_class == "bc", "bc_only").otherwise("elsewhere")).when(own, "bc_only").otherwise(model_class).alias("final_class"),
        F.when(by_rule, "rule").when(own, "bc_only_catalogue").otherwise("llm").alias("decided_by"),
    )


def split_names(entry: Column) -> Column:
    """The names in one entry as written: what stands in brackets, what stands outside; lists in brackets and slashes are cut."""
    inside = F.flatten(F.transform(F.regexp_extract_all(entry, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda t: F.split(t, ",", -1)))
    outside = F.regexp_replace(entry, r"\s*\([^()]*\)\s*", " ")
    pieces = F.flatten(F.transform(F.concat(F.array(outside), inside), lambda p: F.split(p, "/", -1)))
    tidy = F.transform(pieces, lambda p: F.btrim(F.regexp_replace(p, r"\s+", " "), F.lit(" ")))
    return F.array_distinct(F.filter(tidy, lambda p: p != ""))


def search_names(cards: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    """A row for each name that a species can be found by, in its search form."""
    name = lambda df, field, shown, match=None: df.select("specieskey", F.lit(field).alias("field"), shown.alias("name"), tx.search_norm(match if match is not None else shown).alias("norm"))
    parts = [name(cards, "col_name", F.col("col_name")), name(cards.where(F.contains("col_name", F.lit("("))), "col_name", F.col("col_name"), tx.without_subgenus(F.col("col_name")))]
    if "merged_names" in cards.columns:
        merged = cards.select("specieskey", "col_name", F.explode("merged_names").alias("m")).where(tx.without_subgenus(F.col("m.name")) != tx.without_subgenus(F.col("col_name")))
        parts.append(name(merged, "merged_name", F.col("m.name")))
    if entries is not None:
        own = entries.join(cards.select("specieskey"), F.col("gbif_species_key") == F.col("specieskey")).select("specieskey", F.explode("entries").alias("e"))
        blank = lambda c: F.btrim(F.coalesce(c, F.lit("")), F.lit(" ")) != ""
        field = F.when(F.col("e.is_species_level"), "english_name").otherwise("bcsee_entry_english_name")
        parts.append(own.where(blank(F.col("e.common_label"))).select("specieskey", field.alias("field"), F.btrim("e.common_label").alias("name"), tx.search_norm(F.col("e.common_label")).alias("norm")))
        parts.append(name(own.where(blank(F.col("e.scientific_label"))), "bcsee_scientific_label", F.btrim("e.scientific_label"), F.col("e.scientific_label")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("norm <> ''").distinct()


def tiered_search(names: DataFrame, cards: DataFrame, query: str, limit: int = 20, hidden: list[str] | None = None) -> DataFrame:
    """Species whose names hold the query: whole names first, then starts of words, then anywhere; the best name of each."""
    q = tx.search_norm(F.lit(query))
    tier = F.when(F.col("norm") == q, 0).when(F.startswith("norm", q) | F.contains("norm", F.concat(F.lit(" "), q)), 1).otherwise(2)
    place = F.array_position(F.array(*map(F.lit, FIELDS)), F.col("field"))
    hits = names.where(F.contains("norm", q)).withColumns({"tier": tier, "__place": place})
    best = top_per_key(hits, ["specieskey"], [F.col("tier"), F.col("__place"), F.col("name")]).drop("__place", "norm")
    if hidden:
        best = best.where(~F.col("specieskey").isin(hidden))
    found = best.join(cards.select("specieskey", "col_name", "record_count"), "specieskey")
    return found.orderBy("tier", F.desc("record_count"), "col_name", "specieskey").limit(limit)


def match_names(organisms: DataFrame, names: DataFrame, genera: DataFrame, families: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """Names of datasets to species: organisms (dataset_id, entry) -> dataset_id, entry, name, name_norm, status, specieskey, matched_name, matched_field, candidates.

    A name links if its search form (with an abbreviated genus written out when exactly one genus of
    the dataset fits) belongs to one key; more keys are ambiguous, one bare word is a group word, and the
    hand-checked list comes last.
    """
    split = organisms.select("dataset_id", "entry", F.posexplode(split_names(F.col("entry"))).alias("part", "name")).withColumn("name_norm", tx.search_norm(F.col("name"))).where("name_norm <> ''")
    split = top_per_key(split, ["dataset_id", "name_norm"], [F.col("entry"), F.col("part")])
    words = F.split("name_norm", " ")
    known = genera.select(F.col("genus_norm").alias("__genus")).distinct()
    here = split.where(F.size(words) > 1).select("dataset_id", F.get(words, F.lit(0)).alias("__genus")).distinct().join(known, "__genus", "left_semi").where(F.length("__genus") > 1)
    here = here.groupBy("dataset_id").agg(F.array_sort(F.collect_set("__genus")).alias("__genera"))
    split = split.join(here, "dataset_id", "left")
    fits = F.filter(F.coalesce("__genera", F.array().cast("array<string>")), lambda g: F.startswith(g, F.get(words, F.lit(0))))
    short = F.col("name").rlike(r"^\s*[A-Za-z]\.\s*[a-z]") & (F.size(words) > 1) & (F.length(F.get(words, F.lit(0))) == 1) & (F.size(fits) == 1)
    split = split.withColumn("expanded", F.when(short, F.concat_ws(" ", F.get(fits, F.lit(0)), F.array_join(F.slice(words, 2, 100), " ")))).drop("__genera")
    target = F.coalesce("expanded", "name_norm")
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, MATCHED)), F.col("field")), F.lit(0)), F.lit(9))
    hits = names.groupBy(F.col("norm").alias("__t")).agg(F.array_sort(F.collect_set("specieskey")).alias("candidates"), F.min(F.struct(place.alias("p"), F.col("name").alias("n"), F.col("field").alias("f"))).alias("b"))
    out = split.withColumn("__t", target).join(hits, "__t", "left")
    n = F.coalesce(F.size("candidates"), F.lit(0))
    n = F.when(F.col("candidates").isNull(), 0).otherwise(n)
    bare = F.array_join(F.filter(F.split("__t", " "), lambda w: ~w.isin(RANK_WORDS)), " ")
    status = F.when(n == 1, F.when(F.col("expanded").isNotNull(), "expanded_abbreviation").when(F.col("b.f").isin(SCIENTIFIC), "scientific").otherwise("common")).when(n > 1, "ambiguous").when(~F.contains(bare, F.lit(" ")), "group_word").otherwise("unmatched")
    out = out.withColumn("status", status)
    out = out.select("dataset_id", "entry", "name", "name_norm", "expanded", "status", F.when(n == 1, F.get("candidates", F.lit(0))).alias("specieskey"), F.when(n == 1, F.col("b.n")).alias("matched_name"), F.when(n == 1, F.col("b.f")).alias("matched_field"), F.when(n > 1, F.array_join("candidates", ",")).alias("candidates"), bare.alias("bare"))
    ranks = genera.select(F.col("genus_norm").alias("bare"), F.lit("genus").alias("higher_taxon_rank"))
    if families is not None:
        ranks = ranks.unionByName(families.select(F.col("family_norm").alias("bare"), F.lit("family").alias("higher_taxon_rank")))
    ranks = ranks.groupBy("bare").agg(F.max("higher_taxon_rank").alias("higher_taxon_rank"))
    out = out.join(ranks, "bare", "left").withColumn("higher_taxon_rank", F.when(F.col("status").isin("group_word", "unmatched"), F.col("higher_taxon_rank"))).drop("bare")
    if manual is not None:
        m = manual.select(F.col("name_norm"), F.col("specieskey").alias("__k"), F.col("species_name").alias("__n"))
        by_hand = F.col("__k").isNotNull() & ~F.col("status").isin("scientific", "common", "expanded_abbreviation")
        put = lambda c, v: F.when(by_hand, v).otherwise(F.col(c))
        out = out.join(m, "name_norm", "left").withColumns({"specieskey": put("specieskey", F.col("__k")), "matched_name": put("matched_name", F.col("__n")), "matched_field": put("matched_field", F.lit("manual")), "status": put("status", F.lit("manual"))}).drop("__k", "__n")
    return out


def near_names(names: DataFrame, known: DataFrame, distance: int = 2, shortest: int = 5) -> DataFrame:
    """Names up to `distance` letters away from known ones with the same first letter.

    Two texts so close share a form that both reach by leaving out at most so many letters after the
    first: an equi-join on those forms finds the pairs, and the distance settles them.
    """
    asked = names.select(F.col("norm").alias("name_norm")).where(F.length("norm") >= shortest).distinct()
    forms = lambda c: F.explode(_shortened(F.col(c), distance)).alias("__v")
    texts = known.select("norm").distinct()
    pairs = asked.select("name_norm", forms("name_norm")).join(texts.select("norm", forms("norm")), "__v").select("name_norm", "norm").distinct()
    near = pairs.withColumn("distance", F.levenshtein(F.col("name_norm"), F.col("norm"), distance)).where(F.col("distance").between(1, distance))
    return near.join(known, "norm").select("name_norm", *known.columns, "distance")


def _shortened(text: Column, most: int) -> Column:
    """The text, and all that is left of it without one to `most` letters after the first."""
    out = every = F.array(text)
    for _ in range(most):
        cut = lambda t: F.transform(F.sequence(F.lit(2), F.greatest(F.length(t), F.lit(2))), lambda i: F.concat(F.left(t, i - 1), F.substr(t, i + 1)))
        out = F.array_distinct(F.flatten(F.transform(out, cut)))
        every = F.concat(every, out)
    return F.array_distinct(every)


def taxa_in_text(text: Column, genera: set[str], families: set[str], epithets: set[str]) -> Column:
    """Taxa named in a text, as an array of (name, tier, start); a stretch of text is used once.

    Tiers in order: `Genus sp.`, two-part names of known genus and epithet, families, bare genera.
    """
    shapes = [("genus_sp", re.compile(r"\b([A-Z][a-z]+) (?:sp|spp)\b\.?")), ("binomial", re.compile(r"\b([A-Z][a-z]+) ([a-z]{3,})\b")), ("family", re.compile(r"\b([A-Z][a-z]+(?:idae|aceae))\b")), ("genus", re.compile(r"\b([A-Z][a-z]+)\b"))]
    fits = {
        "genus_sp": lambda m: m[1] in genera,
        "binomial": lambda m: m[1] in genera and m[2] in epithets,
        "family": lambda m: m[1] in families,
        "genus": lambda m: m[1] in genera,
    }

    @F.pandas_udf("array<struct<name:string,tier:string,start:int>>")
    def find(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            taken, found = [], []
            for tier, shape in shapes:
                at = 0
                while t and (m := shape.search(t, at)):
                    free = all(m.end() <= a or m.start() >= b for a, b in taken)
                    if free and fits[tier](m):
                        taken.append(m.span())
                        found.append({"name": m[0], "tier": tier, "start": m.start()})
                        at = m.end()
                    else:
                        at = m.end(1)
            out.append(sorted(found, key=lambda x: x["start"]))
        return pd.Series(out)

    return find(text)


#: A capitalised word, and what may make it a name of two parts.
_MENTION = r"(?<![A-Za-z])([A-Z][a-z]{2,})(?![A-Za-z])(?: +(?:(spp?\.)(?![A-Za-z])|([a-z][a-z-]{2,})(?![A-Za-z])))?"
#: Pairs of ordinary words whose second one is an epithet.
NO_SPECIES = ["canada par", "vitesse par", "the minimum", "the major", "the maximum", "flour medium", "parks ontario"]


def taxa_tiers(texts: DataFrame, names: dict[str, DataFrame]) -> DataFrame:
    """Taxa named in texts (id, text), a row (id, tier, name, place) each, in order of place; lists of names by hash joins.

    names: frames with one column `name` for species, genera, epithets, families and higher taxa. Of each
    capitalised word the first tier holds that fits: genus_qualified ("Vulpes sp."), species_found (a
    listed pair), species_off_list (any pair with a listed epithet; the genus may be unlisted),
    family_found, higher_taxa_found, genus_bare. A bare genus that a pair of the text names is left out.
    """
    groups = F.arrays_zip(*(F.regexp_extract_all("text", F.lit(_MENTION), F.lit(i)).alias(c) for i, c in ((1, "w"), (2, "q"), (3, "e"))))
    rows = texts.select("id", F.posexplode(groups).alias("place", "m")).select("id", "place", "m.w", "m.q", "m.e").withColumn("pair", F.concat("w", F.lit(" "), "e"))
    for flag, (column, kind) in {"is_genus": ("w", "genera"), "is_family": ("w", "families"), "is_higher": ("w", "higher"), "is_epithet": ("e", "epithets"), "is_species": ("pair", "species")}.items():
        rows = rows.join(names[kind].select(F.col("name").alias(column)).distinct().withColumn(flag, F.lit(True)), column, "left")
    tier = (
        F.when((F.col("q") != "") & F.col("is_genus"), "genus_qualified").when((F.col("e") != "") & F.col("is_species"), "species_found")
        .when((F.col("e") != "") & F.col("is_epithet") & ~F.lower("pair").isin(NO_SPECIES), "species_off_list").when(F.col("is_family"), "family_found").when(F.col("is_higher"), "higher_taxa_found").when(F.col("is_genus"), "genus_bare")
    )
    name = F.when(F.col("tier") == "genus_qualified", F.concat("w", F.lit(" "), "q")).when(F.col("tier").startswith("species"), F.col("pair")).otherwise(F.col("w"))
    found = rows.withColumn("tier", tier).where("tier is not null").groupBy("id", "tier", "w", name.alias("name")).agg(F.min("place").alias("place"))
    paired = found.where(F.col("tier").isin("genus_qualified", "species_found", "species_off_list")).select("id", "w", F.lit("genus_bare").alias("tier")).distinct()
    return found.join(paired, ["id", "w", "tier"], "left_anti").select("id", "tier", "name", "place")


def coordinates_in_text(text: Column) -> Column:
    """Points, ranges, boxes and single latitudes or longitudes written in a text, as an array of structs; `coordinates` has the forms."""

    @F.pandas_udf("array<struct<" + ",".join(f"{k}:{v}" for k, v in coords.FIELDS.items()) + ">>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[coords.row(f) for f in coords.coordinates(t or "")] for t in texts])

    return find(text)


def similarity(a: Column, b: Column) -> Column:
    """The share of matching text of two titles, as difflib has it without its shortcut for frequent letters."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, p, q, autojunk=False).ratio() if p and q else float("nan") for p, q in zip(x, y, strict=True)])

    return ratio(a, b)


def link_by_any(left: DataFrame, right: DataFrame, keys: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Pairs that agree in at least one key: left_id, right_id, the ways (strongest first) and the strongest; blank keys match nothing.

    Both frames have an `id`. One equi-join for each key; no pair is ever compared without one.
    """
    parts = None
    for way, (a, b) in keys.items():
        x = left.select(F.col("id").alias("left_id"), a.alias("k")).where("k is not null and k <> ''")
        y = right.select(F.col("id").alias("right_id"), b.alias("k")).where("k is not null and k <> ''")
        part = x.join(y, "k").select("left_id", "right_id", F.lit(way).alias("way"))
        parts = part if parts is None else parts.unionByName(part)
    order = list(keys)
    ways = F.filter(F.array(*map(F.lit, order)), lambda w: F.array_contains("s", w))
    return parts.groupBy("left_id", "right_id").agg(F.collect_set("way").alias("s")).select("left_id", "right_id", F.array_join(ways, "+").alias("ways"), F.get(ways, F.lit(0)).alias("strongest"))


def place_norm(col: Column) -> Column:
    """A place name for comparison: plain letters, a leading "the" gone, no stops or apostrophes, single blanks."""
    plain = tx.strip_accents(F.coalesce(col, F.lit("")))
    for letter, ascii_ in SPECIAL:
        plain = F.replace(plain, F.lit(letter), F.lit(ascii_))
    out = F.regexp_replace(F.lower(plain), "[.'’]", "")
    out = F.btrim(F.regexp_replace(out, "[^a-z0-9]+", " "), F.lit(" "))
    return F.regexp_replace(out, "^the (?=.)", "")


def singular(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, "ies$", "y"), "(?<=[a-z]{3}[^s])s$", "")


def find_places(asked: DataFrame, places: DataFrame, threshold: float = 0.8) -> DataFrame:
    """asked (id, name) against places (place_id, norm): exact, then singular, then near, then without a direction word; each step takes what the ones before left."""
    rows = asked.select("id", place_norm(F.col("name")).alias("norm")).where("norm <> ''")
    known = places.select("place_id", F.col("norm").alias("found"))

    def exact(rest, key, how):
        return rest.withColumn("found", key).join(known, "found").select("id", "place_id", F.lit(how).alias("match"), F.lit(1.0).alias("similarity"))

    def near(rest, how):
        longest = F.greatest(F.length("norm"), F.length("found"))
        score = 1 - F.levenshtein(F.col("norm"), F.col("found")) / longest
        long_enough = rest.where(F.length(F.replace("norm", F.lit(" "), F.lit(""))) >= 6).withColumn("p", F.left("norm", F.lit(3)))
        hit = long_enough.join(known.withColumn("p", F.left("found", F.lit(3))), "p").where(F.length("found").between(F.length("norm") * threshold - 1e-9, F.length("norm") / threshold + 1e-9))
        each = F.forall(F.arrays_zip(F.split("norm", " ").alias("a"), F.split("found", " ").alias("b")), lambda w: F.coalesce(F.when(F.least(F.length(w["a"]), F.length(w["b"])) <= 3, w["a"] == w["b"]).otherwise(1 - F.levenshtein(w["a"], w["b"]) / F.greatest(F.length(w["a"]), F.length(w["b"])) >= threshold), F.lit(False)))
        return hit.withColumn("similarity", score).where((F.col("similarity") >= threshold) & each).select("id", "place_id", F.lit(how).alias("match"), "similarity")

    out, rest = None, rows
    for how in ("exact", "singular", "approximate", "direction"):
        if how == "direction":
            cut = F.regexp_replace("norm", "^(?:" + "|".join(DIRECTIONS) + ") ", "")
            step = exact(rest.where(cut != F.col("norm")), cut, how)
        else:
            step = near(rest, how) if how == "approximate" else exact(rest, F.col("norm") if how == "exact" else singular(F.col("norm")), how)
        out = step if out is None else out.unionByName(step)
        rest = rest.join(step.select("id").distinct(), "id", "left_anti")
    return out


def nearest_of_name(points: DataFrame, marks: DataFrame, within_km: float) -> DataFrame:
    """For each point the nearest mark of the same name within a distance: id, mark, km."""
    from taxaloom.functions.geo import distance_km

    m = marks.select("norm", F.col("mark"), F.col("lat").alias("mlat"), F.col("lon").alias("mlon"))
    hit = points.join(m, "norm").withColumn("km", distance_km(F.col("lat"), F.col("lon"), F.col("mlat"), F.col("mlon"))).where(F.col("km") < within_km)
    return hit.groupBy("id").agg(F.min_by("mark", F.struct("km", "mark")).alias("mark"), F.min("km").alias("km"))


def mined_names(text: DataFrame, least: int = 2) -> DataFrame:
    """Pairs `common name (Scientific name)` found in at least `least` records: common, scientific, records."""
    pairs = text.select("id", F.explode(F.regexp_extract_all("text", F.lit(r"((?:[a-z]+ ){1,3}\([A-Z][a-z]+ [a-z]+\))"), F.lit(1))).alias("p"))
    pairs = pairs.select("id", F.btrim(F.regexp_extract("p", r"^([a-z ]+)\(", 1)).alias("common"), F.regexp_extract("p", r"\(([^)]*)\)", 1).alias("scientific"))
    return pairs.groupBy("common", "scientific").agg(F.countDistinct("id").alias("records")).where(F.col("records") >= least)
