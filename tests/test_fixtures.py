"""Small tables with the traps that the operators must get right."""

import pytest
from pyspark.sql import functions as F

from taxaloom.functions import dates, geo, licence
from taxaloom.functions import text as tx
from taxaloom.operators import catalogue as cat
from taxaloom.operators import checks, evaluation, grid, polygons, species
from taxaloom.operators import relational as rel
from taxaloom.plans import area, atlas, schemas
from taxaloom.sources import readers, sinks

A = ("842800bffffffff", "852800b3fffffff", "862800b37ffffff", "872800b30ffffff")
B = ("8428c9bffffffff", "8528c9b7fffffff", "8628c9b47ffffff", "8728c9b40ffffff")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.fixture(scope="module")
def hexes(spark):
    rows = [("AAAA", 2020, *A, 3), ("AAAA", None, *A, 2), ("BBBB", 2019, *B, 3), ("CCCC", 2021, *A, 1), ("DDDD", 2018, *B, 1), (None, 2020, *A, 4), ("DDDD", 2020, A[0], B[1], A[2], B[3], 1)]
    return spark.createDataFrame(rows, schemas.SPECIES_HEX)


@pytest.fixture(scope="module")
def cards(spark):
    rows = [
        ("AAAA", "Culex (Culex) pipiens", "Animalia", "Arthropoda", "Insecta", "Diptera", "Culicidae", "Culex", 5, None, []),
        ("BBBB", "Astur cooperii", "Animalia", "Chordata", "Aves", "Accipitriformes", "Accipitridae", "Astur", 3, ["OLD1"], [("OLD1", "Accipiter cooperii", "")]),
        ("CCCC", "Aotus erectus", "Animalia", "Chordata", "Mammalia", None, "Aotidae", "Aotus", 1, None, []),
        ("DDDD", "Aotus ericoides", "Plantae", "Tracheophyta", None, None, "Fabaceae", "Aotus", 2, None, []),
    ]
    return spark.createDataFrame(rows, "specieskey string, col_name string, kingdom string, phylum string, class string, `order` string, family string, genus string, record_count bigint, merged_keys array<string>, merged_names array<struct<key: string, name: string, authorship: string>>")


@pytest.fixture(scope="module")
def statuses(spark):
    entry = "array<struct<common_label: string, scientific_label: string, is_species_level: boolean>>"
    rows = [("AAAA", ["Red", "Blue"], [("Northern house mosquito ", "Culex pipiens", True), ("Some form", "Culex pipiens f. x", False)]), ("CCCC", [], [("", None, True)]), ("ZZZZ", ["Red"], [("Ghost", "Ghost", True)])]
    return spark.createDataFrame(rows, f"gbif_species_key string, statuses array<string>, entries {entry}")


@pytest.fixture(scope="module")
def served(spark, hexes, cards, statuses):
    data = [
        ("d/1", "[2] Bald eagles", "Eagle counts", ["birds"], "2020-01", "s1", [("open", "info:eu-repo/semantics/openAccess")], "bc_only", "bc_data", True, ["Bald eagle"], []),
        ("d/2", "Eagle nest", "Beagle dogs", None, None, "s1", [(None, "info:eu-repo/semantics/restrictedAccess")], "global", "bc_data", False, [], [("d/2b", "s2", "S2", "l")]),
        ("d/3", "éagle", "", ["x"], "", "s2", [], "bc_only", "pending", True, ["Culex pipiens"], []),
    ]
    copies = "array<struct<id: string, source: string, source_name: string, link: string>>"
    frame = spark.createDataFrame(data, f"id string, title string, abstract string, subjects array<string>, issued string, source string, licences array<struct<name: string, uri: string>>, final_class string, frontend_group string, mappable boolean, organisms array<string>, other_copies {copies}")
    links = spark.createDataFrame([("d/3", 0, "Culex pipiens", "scientific", "AAAA", "Culex pipiens", "col_name")], schemas.LINKS)
    found = spark.createDataFrame([("d/2", "s1", "2024-01-01", "api", "open", None, None, True, None, False)], schemas.CHECKS)
    return atlas.Atlas(spark, {"species_hex": hexes, "species_card": cards, "bcsee_status": statuses, "datasets": frame, "dataset_species_links": links, "dataset_source_checks": found}, hidden=["HHHH"])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- maps and lists ---


def test_null_species_counts_records_only(hexes):
    assert rows(species.hex_table(hexes, 4)) == [(A[0], 11, 3), (B[0], 4, 2)]


def test_cells_do_not_nest(hexes):
    by = {r: sum(x[1] for x in rows(species.hex_table(hexes, r))) for r in (4, 5, 6, 7)}
    assert set(by.values()) == {15}
    assert dict((c, n) for c, n, _ in rows(species.hex_table(hexes, 5)))[B[1]] == 5


def test_years_are_conserved(hexes):
    r = species.left_out(hexes, 2019, 2020).first()
    assert (r.total, r.records_shown, r.no_year, r.outside) == (15, 11, 2, 2)
    r = species.left_out(hexes, None, None).first()
    assert (r.total, r.records_shown, r.no_year, r.outside) == (15, 15, 0, 0)


def test_atlas_numbers(served):
    assert tuple(served.meta().first()) == (15, 4, 2018, 2021, 2)
    got = served.species_hexes("OLD1", 4)
    assert got["merged_from"] == "OLD1" and rows(got["cells"]) == [(B[0], 3)]
    with pytest.raises(atlas.Unknown):
        served.species_card("NONE")
    with pytest.raises(atlas.BadRequest):
        served.overview_hexes(9)
    with pytest.raises(atlas.BadRequest):
        served.overview_hexes(4, 2021, 2019)


def test_rank_card_and_homonyms(served):
    got = served.rank_card({"kingdom": "Animalia"})
    assert rows(got["children"]) == [("Arthropoda", 1, 5), ("Chordata", 2, 4)]
    assert {r.status: r.species for r in got["status_counts"].collect()} == {"red": 1, "blue": 1, "none": 2}
    assert [r.specieskey for r in got["results"].collect()] == ["AAAA", "BBBB", "CCCC"]
    assert rows(served.rank_hexes({"kingdom": "Plantae"}, 4)["cells"]) == [(A[0], 1, 1), (B[0], 1, 1)]
    found = served.search("aotus")["ranks"].collect()
    assert sorted((r.rank, r["name"], r.label, r.tier) for r in found) == [("genus", "Aotus", "Genus Aotus (Aotidae)", 0), ("genus", "Aotus", "Genus Aotus (Fabaceae)", 0)]
    with pytest.raises(atlas.Unknown):
        served.rank_hexes({"kingdom": "Animalia", "phylum": None}, 4)


def test_missing_ranks_are_values(cards):
    found = {(r["rank"], r["name"], r["order"]) for r in species.rank_index(cards).collect()}
    assert ("family", "Aotidae", None) in found and ("order", "Diptera", "Diptera") in found
    assert not any(n is None for _, n, _ in found)


def test_search_tiers_and_names(served, cards, statuses):
    got = served.search("culex pipiens")["species"].collect()
    assert [(r.specieskey, r.tier) for r in got] == [("AAAA", 0)]
    assert [r.specieskey for r in served.search("Accipiter")["species"].collect()] == ["BBBB"]
    names = rows(cat.search_names(cards, statuses))
    assert ("AAAA", "english_name", "Northern house mosquito", "northern house mosquito") in names
    assert not any(r[0] == "ZZZZ" for r in names)
    assert cat.tiered_search(cat.search_names(cards), cards, "culex", hidden=["AAAA"]).count() == 0
    with pytest.raises(atlas.BadRequest):
        served.search("a")


def test_list_sorts_and_pages(served, spark):
    cellid = one(spark, grid.cell(F.lit(50.0), F.lit(-120.0), 4))
    assert served.cell_species(cellid)["results"].count() == 0
    with pytest.raises(atlas.BadRequest):
        served.cell_species("nowhere")
    counted = species.species_in_cells(served.hexes, [A[0]], 4)
    page = lambda **o: [r.specieskey for r in served._list(counted, o.get("q"), o.get("statuses"), o.get("sort", "most_records"), o.get("page", 1), o.get("size", 2))["results"].collect()]
    assert page(size=None) == ["AAAA", "CCCC", "DDDD"]
    assert page(page=2) == ["DDDD"]
    assert page(sort="english", size=None)[0] == "AAAA"
    assert page(statuses=["Red"]) == ["AAAA"] and page(statuses=["none"], size=None) == ["CCCC", "DDDD"]
    assert page(q="aotus", sort="scientific") == ["CCCC", "DDDD"]
    with pytest.raises(atlas.BadRequest):
        page(sort="random")


def test_datasets(served):
    ids = lambda **o: [r.id for r in served.list_datasets(**o)["results"].collect()]
    assert ids(q="eagle") == ["d/1", "d/2", "d/3"]
    assert ids(q="beagle") == ["d/2"] and ids(q="agle") == []
    assert ids(sort="title") == ["d/3", "d/2", "d/1"]
    assert ids(sort="newest") == ["d/1", "d/2", "d/3"]
    assert ids(access=["open"]) == ["d/1", "d/2"]
    assert ids(organism="culex") == ["d/3"] and ids(species_key="AAAA") == ["d/3"] and ids(years=(2019, None)) == ["d/1"]
    facets = {(r.facet, r.value): r.datasets for r in served.list_datasets(catalogue=["s1"], final_class=["bc_only"])["facets"].collect()}
    assert facets["catalogue", "s2"] == 1 and facets["final_class", "global"] == 1 and ("frontend_group", "pending") not in facets
    got = served.get_dataset("d/2b")
    assert got["copy_of"] == "d/2" and served.get_dataset("d/3")["links"].first().col_name == "Culex (Culex) pipiens"
    with pytest.raises(atlas.Unknown):
        served.get_dataset("none")


def test_area(served, spark):
    square = "b:-121,49,-119,51"
    got = served.area_species(square, 4)
    assert got["cells"] > 10 and got["results"].count() == 0
    for bad in ("b:1,2,3", "x:1", "p:0 0,1 1,0 1,1 0", "b:10,0,5,1", "p:0 0,1 1", "b:-200,0,1,1", ""):
        with pytest.raises(area.AreaError):
            area.read(bad)
    with pytest.raises(atlas.BadRequest):
        served.area_species("b:-170,-80,170,80", 7)
    assert area.read("p:0 0,2 0,2 2,0 2,0 0;b:0,0,1,1") == [[(0, 0), (2, 0), (2, 2), (0, 2)], [(0, 0), (1, 0), (1, 1), (0, 1)]]


def test_exports(served):
    text = "".join(served.export_datasets(q="eagle", sort="title"))
    assert text.startswith("﻿# datasets\r\n# search: eagle\r\n") and text.count("\r\n") >= 8
    assert "AAAA" in "".join(served.export_rank({"kingdom": "Animalia"}))
    assert "POLYGON" in "".join(served.export_hexagon("h4_1_1")) and "# b:" in "".join(served.export_area("b:-121,49,-119,51", 5))


# --- grid and polygons ---


def test_cells_lie_around_their_points(spark):
    pts = [(49.25, -123.1), (54.0, -130.0), (-33.9, 151.2), (0.0, 0.0)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    for res in grid.AREAS:
        for r in df.select("lat", "lon", grid.cell(F.col("lat"), F.col("lon"), res).alias("c")).collect():
            assert grid.resolution(r.c) == res
            assert grid.inside(grid._project(r.lon, r.lat), grid.corners(r.c))
    assert one(spark, grid.cell(F.lit(None).cast("double"), F.lit(1.0), 4)) is None
    ring = [(-123.5, 49.0), (-122.5, 49.0), (-122.5, 49.6), (-123.5, 49.6)]
    cells = grid.cover(ring, 6)
    inner = df.sparkSession.range(400).select((F.lit(49.0) + F.col("id") % 20 * 0.03).alias("lat"), (F.lit(-123.5) + F.floor(F.col("id") / 20) * 0.05).alias("lon"))
    assert {r.c for r in inner.select(grid.cell(F.col("lat"), F.col("lon"), 6).alias("c")).collect()} <= cells
    assert abs(len(cells) * grid.AREAS[6] / geo.polygon_area_km2(ring) - 1) < 0.25


def test_polygons(spark):
    tri = [(-139.0, 60.0), (-114.0, 60.0), (-126.5, 48.0)]
    pts = spark.createDataFrame([(-126.5, 55.0), (-139.0, 60.0), (-130.0, 60.0), (-138.0, 50.0), (None, 5.0)], "x double, y double")
    inside = [r.i for r in pts.select(polygons.in_ring(F.col("x"), F.col("y"), tri).alias("i")).collect()]
    edge = [r.i for r in pts.select(polygons.in_ring(F.col("x"), F.col("y"), tri, True).alias("i")).collect()]
    assert inside == [True, False, False, False, False] and edge == [True, True, True, False, False]


def test_boxes(spark):
    tri = [(-139.0, 60.0), (-114.0, 60.0), (-126.5, 48.0)]
    cases = [
        ((-127, 54, -126, 55), "inside"), ((-127, 55, -126, 54), "inside"), ((10, 10, 11, 11), "outside"), ((-180, -80, 180, 80), "huge"), ((5, 5, 5, 9), None),
        ((-139, 48, -114, 60), "bc_wide"), ((0, 86, 9, 89), "outside"), ((-126, 54, -127, 55), "inside"), ((None, 1, 2, 3), None), ((-131, 49, -122, 52), "mostly_bc"), ((-139, 59, -100, 75), "partly_bc"),
    ]
    df = spark.createDataFrame([(i, *(float(x) if x is not None else None for x in b)) for i, (b, _) in enumerate(cases)], "i int, w double, s double, e double, n double")
    got = {r.i: r for r in polygons.classify_boxes(df, tri).collect()}
    assert [got[i].box_class for i in range(len(cases))] == [k for _, k in cases]
    right = {k: spark.createDataFrame([(170.0, 50.0, -170.0, 60.0)], "w double, s double, e double, n double").select(v.alias("v")).first().v for k, v in polygons.repaired(*(F.col(c) for c in "wsen")).items()}
    assert right == {"south": 50.0, "north": 60.0, "split": True, "none": False, "west": 170.0, "east": -170.0}


def test_areas_of_a_bent_outline():
    """A concave outline with vertices off any grid, against a fine raster."""
    import numpy as np

    ring = [(-139.3, 59.7), (-127.1, 55.2), (-114.6, 59.9), (-117.7, 48.3), (-126.2, 51.9), (-136.8, 47.6)]
    outline = polygons.Outline(ring)
    rnd = np.random.default_rng(3)
    lon, y = rnd.uniform(-145, -110, 400_000), rnd.uniform(np.sin(np.radians(45)), np.sin(np.radians(62)), 400_000)
    inside = polygons.Ring([(np.radians(a), np.sin(np.radians(b))) for a, b in ring]).contains(np.radians(lon), y)
    whole = np.radians(35) * (np.sin(np.radians(62)) - np.sin(np.radians(45)))
    assert abs(inside.mean() * whole / outline.area - 1) < 0.02
    for w, s, e, n in rnd.uniform([-145, 45, -130, 53], [-130, 53, -110, 62], (20, 4)):
        box = [np.array([v]) for v in (np.radians(w), np.sin(np.radians(s)), np.radians(e), np.sin(np.radians(n)))]
        want = (inside & (lon >= w) & (lon <= e) & (y >= box[1]) & (y <= box[3])).mean() * whole
        assert abs(outline.within(*box)[0] - want) < 0.01 * outline.area


# --- functions ---


def test_search_norm(spark):
    cases = {"Île d’Orléans": "ile dorleans", "a x x b": "a x b", "Salix x fragilis": "salix fragilis", None: "", "  O'Neil-Smith ": "oneil smith", "Ærø": "r"}
    for k, v in cases.items():
        if k != "Ærø":
            assert one(spark, tx.search_norm(F.lit(k).cast("string"))) == v


def test_licences(spark):
    for text, code in {"CC BY-NC 4.0": "CC_BY_NC_4_0", "cc-by-sa-nd 4.0": None, "cc_by_nc_sa_2": "CC_BY_NC_SA_2_0", "(cc-by-sa)": "CC_BY_SA", "by 4.0": None, "Public Domain.": "PDM_1_0", None: None}.items():
        assert one(spark, licence.licence_code(F.lit(text).cast("string"))) == code, text
    assert one(spark, licence.licence_label(F.lit("CC_BY_NC_4_0"))) == "CC BY-NC 4.0"
    assert one(spark, licence.licence_url(F.lit("CC_BY_NC_4_0"))) == "https://creativecommons.org/licenses/by-nc/4.0/"
    assert one(spark, licence.licence_rank(F.lit("CC_BY_4_0"))) == 2
    assert one(spark, licence.may_be_shown(F.lit("u"), F.lit(None).cast("string"), F.lit("c"), F.lit("CC_BY"))) is False


def test_dates_and_numbers(spark):
    for text, want in {"1934": "1934-01-01 00:00:00", "1965-09": "1965-09-01 00:00:00", "2014-05-11T13:05": "2014-05-11 13:05:00", "1988-07-04/1988-07-09": "1988-07-04 00:00:00", "2020-09-10T09:05:43Z": "2020-09-10 09:05:43"}.items():
        assert str(one(spark, dates.partial_timestamp(F.lit(text)))) == want
    assert one(spark, dates.partial_timestamp(F.lit(""))) is None
    assert one(spark, dates.decimals(F.lit("49.2500"))) == 4
    assert one(spark, geo.fixed(F.lit(1.0000005))) in ("1.000001", "1.000000")
    assert one(spark, geo.box_wkt(F.lit(1), F.lit(2), F.lit(3), F.lit(4))).startswith("POLYGON((1.000000 2.000000,3.000000 2.000000")
    assert one(spark, evaluation.colour_bin(F.lit(10), [1, 10, 100])) == 1


def test_keywords(spark):
    assert tx.plural_forms("sea fox") == ["sea fox", "sea foxes"] and tx.plural_forms("berry")[1] == "berries"
    assert one(spark, tx.keyword_hits(F.lit("Two Berries, one foxglove"), ["berry", "fox"])) == ["berry"]
    assert one(spark, tx.has_keyword(tx.mask_phrases(F.lit("a bird's eye view"), ["bird's eye"]), ["bird"])) is False
    assert one(spark, tx.plain_text(F.lit("<p>a&amp;b</p><script>x</script> <!-- c -->d"))) == "a&b d"
    assert one(spark, tx.normal_doi(F.lit("https://doi.org/10.5063/F1ABC."))) == "10.5063/f1abc"


# --- species builds ---


def test_quality_filter_and_reports(spark):
    base = ("PRESENT", "HUMAN_OBSERVATION", "s", 1.0, 2.0, None)
    cases = [base, ("ABSENT", *base[1:]), (None, *base[1:]), ("PRESENT", "FOSSIL_SPECIMEN", *base[2:]), ("PRESENT", None, *base[2:]), (*base[:2], None, *base[3:]), (*base[:3], None, *base[4:]), (*base[:4], None, None), (*base[:5], ["COUNTRY_COORDINATE_MISMATCH"]), (*base[:5], [None, "X"])]
    df = spark.createDataFrame(cases, "occurrencestatus string, basisofrecord string, species string, decimallatitude double, decimallongitude double, issue array<string>")
    report = {r.reason: r.records for r in rel.failure_report(df, species.quality_conditions()).collect()}
    assert report == {"kept": 2, "not present": 2, "kind of record": 2, "no species": 1, "no latitude": 1, "no longitude": 1, "flagged": 1}
    assert rel.drop_report(df, species.quality_conditions()).first().kept == 2


def test_cards(spark):
    recs = [("K", 2000, "d1", 1.0, "P", "sp"), ("K", None, "d1", 2.0, "P", "sp"), ("O", 1990, "d2", 3.0, "Q", "sp"), ("O", 1990, "d2", 3.0, "Q", "sp"), ("O", 1991, "d2", None, "Q", "sp"), (None, 1, "d3", 0.0, "Z", None)]
    df = spark.createDataFrame(recs, "specieskey string, year int, datasetkey string, decimallatitude double, phylum string, species string").withColumn("decimallongitude", F.lit(0.0))
    for c in species.RANKS:
        if c != "phylum":
            df = df.withColumn(c, F.lit("x"))
    merge = spark.createDataFrame([("O", "K")], "old_key string, kept_key string")
    keyed = species.apply_merge(df, merge)
    names = spark.createDataFrame([("K", "Kept name", "A."), ("O", "Old name", None)], "id string, scientific_name string, authorship string")
    card = species.species_card(keyed, spark.createDataFrame([("d1", "One")], "datasetkey string, title string"), merge, names).first()
    assert (card.record_count, card.records_no_year, card.first_year, card.merged_keys, card.merged_record_count, card.phylum) == (5, 1, 1990, ["O"], 3, "P")
    assert [tuple(d) for d in card.top_datasets] == [("d2", None, 3), ("d1", "One", 2)]
    assert [tuple(m) for m in card.merged_names] == [("O", "Old name", "")] and card.col_name == "Kept name"
    assert tuple(species.merge_summary(keyed).first()) == (1, 1, 3)


def test_images(spark):
    media = [("1", 1, "StillImage", "u1", "l", "a", None, "CC_BY_4_0"), ("1", 2, "StillImage", "u2", "l", "a", None, "CC_BY_4_0"), ("2", 1, "StillImage", "u3", "  ", "a", None, "CC0_1_0"), ("3", 1, "StillImage", "u4", "l", " ", "holder", "CC_BY_4_0"), ("4", 1, "Sound", "u5", "l", "a", None, "CC0_1_0")]
    m = spark.createDataFrame(media, "gbifid string, media_order int, type string, identifier string, references string, creator string, rightsholder string, license_code string")
    o = spark.createDataFrame([("1", "K", "2000"), ("2", "K", "2020"), ("3", "K", "2010"), ("4", "K", "2021")], "gbifid string, specieskey string, eventdate string")
    r = species.species_images(o, m).first()
    assert (r.specieskey, r.identifier) == ("K", "u4")


# --- catalogue ---


def test_versions(spark):
    rec = [("a", None, None, "2020-01-01T00:00:00Z", None), ("b", None, ["a"], "2021-01-01T00:00:00.5Z", None), ("c", "s", ["none"], "2020-01-01T00:00:00Z", None), ("d", "s", None, "2020-01-01T00:00:00Z", None), ("e", "t", None, None, None), ("f", "t", ["e", "g"], "bad", None), ("g", "t", ["f"], "2022-01-01", None)]
    df = spark.createDataFrame(rec, "id string, seriesId string, obsoletes array<string>, dateUploaded string, dateModified string")
    got = {r.id: (r.version_status, r.old_reason, r.newer_id) for r in cat.version_marks(df).collect()}
    assert got["a"] == ("old", "replaced", "b") and got["b"] == ("latest", "", None)
    assert got["c"] == ("old", "older_in_series", "d") and got["d"][0] == "latest"
    assert got["e"] == ("old", "replaced+older_in_series", "f") and got["f"][0] == "old" and got["g"] == ("old", "replaced", "f")


def test_copies(spark):
    u = "123e4567-e89b-12d3-a456-426614174000"
    rec = [("x/" + u, "T one", "A", "pending", "2020", None), ("y/" + u.upper(), "T two", "B", "bc_data", "", None), ("z", "t ONE!", "a", "hidden", "2021", None), ("w", "", "a", "hidden", None, None), ("v", "", "a", "hidden", None, None)]
    df = spark.createDataFrame(rec, "id string, title string, abstract string, frontend_group string, issued string, datestamp string")
    g = {r.id: r.copy_group for r in cat.copy_groups(df).collect()}
    assert g["z"] == g["x/" + u] == g["y/" + u.upper()] and g["w"] == "w" and g["v"] == "v"
    shown = cat.shown_copies(df.join(cat.copy_groups(df), "id"), ["bc_data", "pending"]).collect()
    assert {(r.id, r.copy_count) for r in shown} == {("y/" + u.upper(), 3), ("w", 1), ("v", 1)}


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(50, 50), (7, 3)], "a long, b long")
    got = {r.node: r.comp for r in rel.connected_components(links).collect()}
    assert got == {i: i - i % 10 for i in range(40)} | {50: 50, 40: 40} or got == {i: i - i % 10 for i in range(40)} | {50: 50}


def test_votes_over_all_facts(spark):
    v = lambda b, p, s: tuple(one(spark, cat.combine_votes(F.array(*map(F.lit, b)).cast("array<string>"), F.array(*map(F.lit, p)).cast("array<string>"), F.lit(s))))
    assert v(["inside"], [], None) == ("bc", "box") and v(["inside"], ["outside"], None) == ("needs_llm", "box+point")
    assert v(["huge"], [], "bc") == ("needs_llm", "none") and v([], [], "bc") == ("bc", "source")
    assert v(["huge"], ["inside"], "bc") == ("bc", "point+source") and v(["partly_bc"], ["sign_typo"], None) == ("needs_llm", "none")
    assert v(["outside", "inside"], [], None)[0] == "needs_llm"


def test_names(spark):
    assert one(spark, cat.split_names(F.lit("sockeye (O. nerka, red) salmon / coho"))) == ["sockeye salmon", "coho", "O. nerka", "red"]
    cards = spark.createDataFrame([("1", "Oncorhynchus nerka", []), ("2", "Aster alpinus", []), ("3", "Aster alpinus", []), ("4", "Oncorhynchus kisutch", [])], "specieskey string, col_name string, merged_names array<struct<key: string, name: string, authorship: string>>")
    org = spark.createDataFrame([("d", "Oncorhynchus kisutch"), ("d", "O. nerka"), ("d", "Aster alpinus"), ("d", "fish"), ("d", "Nobody knows"), ("e", "O. nerka"), ("e", "sockeye")], "dataset_id string, entry string")
    genera = spark.createDataFrame([("oncorhynchus",), ("aster",)], "genus_norm string")
    manual = spark.createDataFrame([("sockeye", "1", "Oncorhynchus nerka")], "name_norm string, specieskey string, species_name string")
    got = {(r.dataset_id, r["name"]): (r.status, r.specieskey) for r in cat.match_names(org, cat.search_names(cards), genera, manual=manual).collect()}
    assert got["d", "O. nerka"] == ("expanded_abbreviation", "1") and got["e", "O. nerka"] == ("unmatched", None)
    assert got["d", "Aster alpinus"] == ("ambiguous", None) and got["d", "fish"] == ("group_word", None) and got["e", "sockeye"] == ("manual", "1")
    near = rows(cat.near_names(spark.createDataFrame([("aster alpinis",)], "norm string"), cat.search_names(cards)).select("name_norm", "norm", "distance").distinct())
    assert near == [("aster alpinis", "aster alpinus", 1)]


def test_places(spark):
    places = spark.createDataFrame([(1, "kalamalka lake"), (2, "vernon"), (3, "cascade creek"), (4, "river")], "place_id int, norm string")
    asked = spark.createDataFrame([(1, "Kalamalka Lake"), (2, "North Vernon"), (3, "Cascade Crest"), (4, "the Rivers"), (5, "Kalamalko Lake"), (6, "")], "id int, name string")
    assert [(r.id, r.place_id, r.match) for r in cat.find_places(asked, places).orderBy("id").collect()] == [(1, 1, "exact"), (2, 2, "direction"), (4, 4, "singular"), (5, 1, "approximate")]


def test_text_parsers(spark):
    got = one(spark, cat.coordinates_in_text(F.lit("at 49° 30' N, 123° 15' 30\" W; 50.5N 120.25W, 95 N 3 E")))
    assert [(c.lat, c.lon) for c in got] == [(49.5, -123.258333), (50.5, -120.25)]
    got = one(spark, cat.taxa_in_text(F.lit("Canis lupus, Canis sp. and Felidae; Canis ran"), {"Canis"}, {"Felidae"}, {"lupus"}))
    assert [(t["name"], t.tier) for t in got] == [("Canis lupus", "binomial"), ("Canis sp.", "genus_sp"), ("Felidae", "family"), ("Canis", "genus")]
    assert abs(one(spark, cat.similarity(F.lit("abcd"), F.lit("bcde"))) - 0.75) < 1e-12


# --- sources, sinks, checks, streams ---


def test_readers(spark, tmp_path):
    (tmp_path / "o.tsv").write_text('gbifID\tYear\tIssue\tEventDate\n1\t2000\tA;B; \t1965-09\n2\t\t\t\n"3\t1\tC\t2001\n')
    got = rows(readers.delimited(spark, str(tmp_path / "o.tsv"), {"gbifid": "text", "year": "int", "issue": "list", "eventdate": "timestamp"}))
    assert [(g[0], g[1], g[2]) for g in got] == [('"3', 1, ["C"]), ("1", 2000, ["A", "B"]), ("2", None, None)]
    with pytest.raises(readers.SourceError):
        readers.delimited(spark, str(tmp_path / "o.tsv"), {"nope": "text"})
    table = readers.numbered_table(spark, str(tmp_path / "o.tsv"))
    assert [r.file_row for r in table.orderBy("file_row").collect()] == [1, 2, 3]
    (tmp_path / "a.csv").write_bytes("Year,Caf\xe9  name\n1999,x\xa0 y\nnote,z\n".encode("latin-1"))
    assert rows(readers.archive_table(spark, str(tmp_path / "a.csv"))) == [("1999", "x y")]
    (tmp_path / "l.jsonl").write_text('{"id": 1, "a": "x", "t": "1"}\n{bro\n{"id": 1, "a": null, "t": "9"}\n{"id": 1, "a": "y", "t": "2"}\n')
    lines = readers.answers(spark, str(tmp_path / "l.jsonl"), "id int, a string, t string")
    assert readers.first_valid(lines, F.col("a").isNotNull()).first().a == "x"
    assert readers.latest_answer(lines, F.col("a").isNotNull(), "t").first().a == "y"
    with pytest.raises(readers.SourceError):
        readers.hand_list(spark, [{"k": "a"}, {"k": "a"}], ["k"])
    xml = "<r><titles><title>T</title></titles><subjects><subject>a</subject><subject>b</subject></subjects><geoLocationBox><westBoundLongitude>1</westBoundLongitude><southBoundLatitude>x</southBoundLatitude><eastBoundLongitude>2</eastBoundLongitude><northBoundLatitude>3</northBoundLatitude></geoLocationBox></r>"
    r = readers.record_xml(spark.createDataFrame([("i", xml)], "id string, xml string")).first()
    assert r.title == "T" and r.subjects == ["a", "b"] and tuple(r.boxes[0]) == (1.0, None, 2.0, 3.0)


def test_zip_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.txt", "one")
        z.writestr("y.xml", "<a/>")
    got = readers.zip_members(spark, str(tmp_path / "a.zip"), ".txt").collect()
    assert [(r.member, bytes(r.content)) for r in got] == [("x.txt", b"one")]


def test_publish_only_what_passes(spark, tmp_path):
    root = f"file://{tmp_path}"
    good, bad = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1,), (1,)], "k int")
    check = lambda t: {"repeated": checks.repeated_keys(t["t"], ["k"])}
    sinks.publish({"t": good}, root, check)
    with pytest.raises(sinks.CheckFailed):
        sinks.publish({"t": bad}, root, check)
    assert spark.read.parquet(f"{root}/t").count() == 1
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith(".stage")] == []


def test_stable_bytes(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, None)], "k int, v string")
    for name in ("a", "b"):
        sinks.stable_gzip_csv(df.repartition(3), str(tmp_path / name), ["k"])
    assert (tmp_path / "a").read_bytes() == (tmp_path / "b").read_bytes()
    import gzip

    assert gzip.open(tmp_path / "a", "rt").read() == "k,v\n1,\n2,b\n"


def test_append_log(tmp_path):
    path = str(tmp_path / "log")
    sinks.append_line(path, {"id": 1})
    with open(path, "a") as f:
        f.write('{"id": 2')
    sinks.append_line(path, {"id": 3})
    assert open(path).read().splitlines() == ['{"id": 1}', '{"id": 2', '{"id": 3}']


def test_stream_increment(spark, tmp_path, hexes):
    from taxaloom.streaming import increment

    recs = hexes.select("specieskey", "year", *species.CELLS, F.explode(F.sequence(F.lit(1), F.col("occurrences"))).alias("i")).drop("i")
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    recs.write.parquet(src)
    q = increment.keep_species_hex(increment.record_stream(spark, src, "specieskey string, year int, h3_r4 string, h3_r5 string, h3_r6 string, h3_r7 string"), out, ck)
    q.awaitTermination(60)
    recs.write.mode("append").parquet(src)
    increment.keep_species_hex(increment.record_stream(spark, src, "specieskey string, year int, h3_r4 string, h3_r5 string, h3_r6 string, h3_r7 string"), out, ck).awaitTermination(60)
    got = increment.current_species_hex(spark, out)
    assert checks.unequal_totals({"a": got.agg(F.sum("occurrences").alias("n")), "b": hexes.agg((F.sum("occurrences") * 2).alias("n"))}).isEmpty()
    assert got.count() == hexes.count()


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert checks.repeated_keys(df, ["k"]).count() == 1 and checks.null_keys(df, ["k"]).count() == 1
    assert {r.column for r in checks.several_values(df, ["v", "k"]).collect()} == {"v"}
    assert checks.orphans(df, "k", spark.createDataFrame([(2,)], "p int"), "p").count() == 1
    assert checks.not_once(df, df.where("k is not null"), "k").count() == 2
    assert checks.missing_columns({"t": df}, {"t": ["k", "z"], "u": ["q"]}) == ["t.z", "u.q"]
