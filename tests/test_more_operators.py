import pytest
from pyspark.sql import functions as F

from taxaloom.functions import links
from taxaloom.operators import authors, places, statuses
from taxaloom.sources import sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_nested_statuses(spark):
    row = lambda code, status, label, common, level, syn, key="1", name="Aus bus": (key, name, status, label, "GBIF" if code != "E3" else "BCSEE", common, level, syn, "m" + key, code)
    rows = [row("E1", "Blue", "Aus bus ssp. cus", "", False, True), row("E2", "Red", "Aus bus", "Bird", True, True), row("E3", "Red", "Aus bus", "Bird", False, False), row("E4", "No Status", "Aus dus", "", True, False), row("E5", "Yellow", "Solo", "", True, False, "2", "Solo")]
    df = spark.createDataFrame(rows, "gbif_species_key string, species_name string, status string, scientific_label string, name_source string, common_label string, is_species_level boolean, is_gbif_synonym boolean, matched_species_key string, element_code string")
    got = {r.gbif_species_key: r for r in statuses.nested(df).collect()}
    a = got["1"]
    assert a.status_display == "Red: Aus bus [Bird]; No Status: Aus dus; Blue: Aus bus ssp. cus"
    assert a.has_multiple and a.has_separate_bcsee_species and a.statuses == ["Red", "Blue"]
    assert a.element_codes == ["E2", "E3", "E4", "E1"] and not any(e.is_species_level for e in a.entries)
    assert [e.is_gbif_synonym for e in a.entries] == [False, False, True]
    assert got["2"].entries[0].is_species_level and not got["2"].has_multiple


def test_flags_and_questions(spark):
    rows = [("k", "EXACT", None, "Species", "ACCEPTED", "Aus bus"), ("k", "EXACT", None, "Species", "MISAPPLIED", "Aus bus"), (None, "EXACT", None, None, None, "Aus bus"), ("k", "HIGHERRANK", "SPECIES", "Subspecies", None, "Aus bus cus"), ("k", "HIGHERRANK", "SPECIES", "Species", None, "Aus bus"), ("k", "EXACT", None, "Species", None, "Aus sp. 1"), ("k", "VARIANT", None, "Species", None, "Aus bus")]
    df = spark.createDataFrame(rows, "gbif_species_key string, gbif_match_type string, gbif_rank string, classification_level string, gbif_status string, scientific_name string")
    got = [(r.join_ok, r.needs_review) for r in statuses.with_flags(df).collect()]
    assert got == [(True, False), (False, True), (False, False), (True, False), (False, True), (False, True), (False, True)]
    asked = spark.createDataFrame([("Aus bus", " ", "Fam ")], "scientific_name string, kingdom string, family string").select(statuses.question(["kingdom", "family"]).alias("q")).first().q
    assert asked == ["scientific_name=Aus bus", "family=Fam"]
    assert one(spark, statuses.written_name(F.lit("Aus bus cus"), F.lit("Aus × bus cus"), F.lit("SUBSPECIES"), F.lit("Plantae"))) == "Aus x bus ssp. cus"
    assert one(spark, statuses.written_name(F.lit("Aus bus cus"), F.lit("Aus bus cus"), F.lit("SUBSPECIES"), F.lit("Animalia"))) == "Aus bus cus"


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [("(Mill.) Britton", "Britton", True), ("L.", "Linnaeus, 1758", True), ("Smith & Jones", "Jones et Smith, 1900", True), ("Smith", "Jones", False), ("Douglas ex Hook.", "Hooker", True), ("Herbst, J.F.W.", "Herbst", True), ("Smith in Jones", "Smith", True), ("(Stephens, 1836)", "Stephens", True), ("Smith", "Smith & Jones", False), (None, "L.", False), ("Rich.", "Richardson", True), ("DC.", "de Candolle", True), ("Nees", "Nees von Esenbeck", True), ("De Geer", "DeGeer, 1773", True), ("Kütz.", "Kuetzing", True), ("Lam.", "Lamarck", True), ("Ric.", "Richardson", False), ("L.", "Lamarck", False), ("A ex B in C", "B", True), ("Smith (Jones) Miller", "Smith Miller", True), ("", "", False)],
)
def test_authors(a, b, same):
    assert authors.same_people(authors.parse(a)[0], authors.parse(b)[0]) is same


def test_authorship_parts():
    main, first, years = authors.parse("(Mill.) Britton & Rose, 1920")
    assert [x.name for x in main] == ["britton", "rose"] and [x.name for x in first] == ["mill"] and years == {"1920"}


def test_synonym_rule(spark):
    names = [("K", None, "accepted", "Kus", "A."), ("O", None, "accepted", "Ous", "B."), ("S1", "K", "synonym", "Ous", "B."), ("P", None, "accepted", "Pus", "B."), ("S2", "K", "ambiguous synonym", "Pus", "B."), ("Q", None, "accepted", "Qus", None)]
    n = spark.createDataFrame(names, "id string, parent_id string, status string, scientific_name string, authorship string")
    m = spark.createDataFrame([("O", "K"), ("P", "K"), ("Q", "K"), ("Z", "K")], "old_key string, kept_key string")
    got = {r.old_key: r.problem for r in statuses.synonym_problem(m, n).collect()}
    assert got == {"O": None, "P": "ambiguous synonym", "Q": "not listed as a synonym", "Z": "a key is not in the checklist"}


def test_mentions_and_hints(spark):
    m = lambda t: one(spark, places.mentions(F.lit(t), ["Haida Gwaii"]))
    assert m("In British Columbia, B.C. and Haida Gwaii") == ["British Columbia", "B.C.", "Haida Gwaii"]
    assert m("in 300 BC") == [] and m("near Hope, BC") == ["BC"]
    h = lambda p: tuple(one(spark, places.hint(F.array(*map(F.lit, p)).cast("array<string>"), ["Haida Gwaii"])))
    assert h(["Alberta", "Yukon"]) == ("elsewhere", "Alberta, Yukon") and h(["Canada"]) == ("canada", "Canada") and h([]) == ("", "") and h(["Haida Gwaii", "Alberta"])[0] == "bc"
    assert one(spark, places.filled_in(F.lit("unclear"), F.lit("no"), F.lit("no"), F.array(F.lit(None).cast("double"), F.lit(0.5)))) == "yes"


def test_boxes(spark):
    f = lambda *e: one(spark, places.box_flags(*(F.lit(float(x)) for x in e)))
    assert f(-141, 42, -53, 83) == ["matches_canada_extent"] and f(1, 5, 0, 2) == ["swapped"] and f(170, 0, -170, 1) == [] and f(1, 2, 1, 2) == ["zero_width"] and f(-180, -90, 180, 90) == ["most_of_world"]
    box = "array<struct<w: double, s: double, e: double, n: double>>"
    df = spark.createDataFrame([("a", [(1.0, 2.0, 1.0, 2.0)], []), ("b", [(1.0, 2.0, 3.0, 4.0)], []), ("c", [], [1]), ("d", None, None)], f"id string, boxes {box}, points array<int>")
    assert {r.id: r.m for r in df.select("id", places.mappable(F.col("boxes"), F.col("points")).alias("m")).collect()} == {"a": False, "b": True, "c": True, "d": False}
    rights = "array<struct<name: string, uri: string>>"
    d = spark.createDataFrame([([(None, places.ACCESS + "restrictedAccess")],), ([("x", places.ACCESS + "openAccess")],), ([],)], f"r {rights}")
    assert [r.a for r in d.select(places.record_access(F.col("r")).alias("a")).collect()] == ["restricted", None, None]
    assert one(spark, places.access_agrees(F.lit("open"), F.lit("login"), ["open"])) is False


def test_place_ranking(spark):
    rows = [(1, 10, "CA", 5, 0, True, 1.0, "main", "x"), (1, 11, "US", 900, 0, False, 1.0, "main", "x"), (1, 10, "CA", 5, 0, True, 0.9, "alternate", "x")]
    df = spark.createDataFrame(rows, "id int, geonameid int, country_code string, population bigint, strength int, agrees boolean, similarity double, name_type string, norm string")
    best = places.best_rows(df)
    assert sorted((r.geonameid, r.similarity) for r in best.collect()) == [(10, 1.0), (11, 1.0)]
    assert [r.geonameid for r in places.ranked(best).orderBy("place").collect()] == [10, 11]


def test_shown_licences(spark):
    s = links.shown_licence
    assert s(None, links.ACCESS + "openAccess") is None and s("None", "") is None
    assert s("<a href=\"https://x.org/l", "\">My &amp; licence</a>") == "My & licence (https://x.org/l)"
    assert s("", "https://spdx.org/licenses/CC-BY-4.0.html") == "CC-BY-4.0 (https://spdx.org/licenses/CC-BY-4.0.html)"
    assert s("<p>One</p><p>Two</p>", "") == "One Two" and s("", "") == links.UNNAMED
    df = spark.createDataFrame([([("CC0", None), (None, links.ACCESS + "openAccess")],), (None,)], "l array<struct<name: string, uri: string>>")
    assert [r.x for r in df.select(links.shown_licences(F.col("l")).alias("x")).collect()] == [["CC0"], []]


def test_rings_and_zoom():
    assert links.pasted_rings("POLYGON ((0 0, 1 0, 1 1, 0 0))") == [[(0, 0), (1, 0), (1, 1), (0, 0)]]
    assert len(links.pasted_rings("MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))")) == 2
    assert links.pasted_rings('{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}}') == [[(0, 0), (1, 0), (1, 1)]]
    ring = [(0.0, 0.0), (0.5, 0.001), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    assert links.simplified(ring, 0.01) == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    edges = {4: 0, 5: 6, 6: 8, 7: 10}
    assert links.picked_resolution(6.1, 4, edges) == 4 and links.picked_resolution(6.3, 4, edges) == 5 and links.picked_resolution(5.9, 5, edges) == 5 and links.picked_resolution(9, None, edges) == 6
    assert links.one_link_for_all(10**6, 100) and not links.one_link_for_all(10, 100)


def test_display_url(spark):
    assert one(spark, links.display_url(F.lit("https://static.inaturalist.org/photos/12/original.jpg"))) == "https://static.inaturalist.org/photos/12/medium.jpg"
    assert one(spark, links.display_url(F.lit("http://x/original.jpg"))) == "http://x/original.jpg"


def test_publish_puts_back_what_was_there(spark, tmp_path):
    """A place that cannot be taken: both old tables stand as they were."""
    root = f"file://{tmp_path}"
    one_, two = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    sinks.publish({"a": one_}, root, lambda t: {})
    (tmp_path / "blocked").write_text("a file, where a folder should be")
    with pytest.raises(Exception):
        sinks.publish({"a": two, "blocked/b": two}, root, lambda t: {})
    assert spark.read.parquet(f"{root}/a").count() == 1
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith(".stage")] == []


def test_answers_of_a_file_in_several_parts(spark, tmp_path):
    from taxaloom.sources import readers

    (tmp_path / "l.jsonl").write_text("".join(f'{{"id": {i % 7}, "n": {i}, "pad": "{"x" * 60}"}}\n' for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = readers.answers(spark, str(tmp_path / "l.jsonl"), "id int, n int, pad string")
        assert rows.rdd.getNumPartitions() > 3
        assert {r.id: r.n for r in readers.first_valid(rows, F.col("n") >= 700).collect()} == {i % 7: i for i in range(700, 707)}
        assert [r.n for r in rows.orderBy("file", "place").collect()] == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_search_form_on_the_driver(spark):
    from taxaloom.functions import text as tx

    cases = ["Île d’Orléans", "a x x b", "Việt Nam", "Café X  Y", "O'Neil-Smith", "x", "", "АЙ 12", "Ǣǻ ṩ"]
    got = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string").select("i", tx.search_norm(F.col("c")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [tx.search_form(c) for c in cases]
    assert tx.search_form("Việt") == "viet"


def test_served_tables_are_built_once(spark, tmp_path):
    from taxaloom.plans.shared import served

    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(str(tmp_path / "in"))

    write = lambda df, path: df.write.parquet(path)
    spark.range(3).write.parquet(str(tmp_path / "in"))
    assert served(spark, "t", [str(tmp_path / "in")], build, write).count() == served(spark, "t", [str(tmp_path / "in")], build, write).count() == 3
    assert len(calls) == 1
    spark.range(5).write.mode("append").parquet(str(tmp_path / "in"))
    assert served(spark, "t", [str(tmp_path / "in")], build, write).count() == 8 and len(calls) == 2


def test_no_cell_arithmetic_in_filters(spark, sf_dir):
    from taxaloom.plans import driver_queries

    for name in ("overview_hexes", "species_map", "rank_map", "area_species", "cell_species_list"):
        plan = driver_queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "FLOOR" not in plan.upper(), name


def test_page_items():
    from taxaloom.operators.audits import page_items

    assert page_items(10, 64) == [1, None, 9, 10, 11, None, 64]
    assert page_items(1, 64) == [1, 2, 3, 4, 5, None, 64] == page_items(4, 64)
    assert page_items(64, 64) == [1, None, 60, 61, 62, 63, 64] == page_items(61, 64)
    assert page_items(10, 64, 0) == [1, None, 10, None, 64]
    assert page_items(2, 7) == [1, 2, 3, 4, 5, 6, 7] and page_items(1, 0) == []


def test_refused_settings():
    from taxaloom.operators.audits import refuse_setting

    refuse_setting("MAX_RES", None)
    refuse_setting("MAX_RES", " ")
    with pytest.raises(ValueError):
        refuse_setting("MAX_RES", 5)


def test_cell_tables_and_boxes(spark, tmp_path):
    import gzip

    from taxaloom.sources import readers

    text = b"cell,records\nh4_1_2,5\nh4_1_3,\n"
    (tmp_path / "plain.csv.gz").write_bytes(text)
    (tmp_path / "packed.csv").write_bytes(gzip.compress(text))
    for name in ("plain.csv.gz", "packed.csv"):
        assert [tuple(r) for r in readers.cell_table(spark, str(tmp_path / name), "cell string, records bigint").collect()] == [("h4_1_2", 5), ("h4_1_3", None)]
    spark.createDataFrame([(1, -125.0, 50.0), (2, -100.0, 50.0), (3, None, 50.0), (4, -120.0, 61.0)], "id int, decimallongitude double, decimallatitude double").write.parquet(str(tmp_path / "p"))
    df = readers.in_box(spark, str(tmp_path / "p"), ["id"], (-139, 48, -114, 60))
    assert [r.id for r in df.collect()] == [1]
    assert "GreaterThanOrEqual(decimallongitude" in df._jdf.queryExecution().executedPlan().toString()
