"""Queries without SQL over documents whose hits stand late in long texts."""

import difflib
import re

import pytest

from taxaloom.plans import driver_queries

FILL = "plain words without any name at all, " * 60
TEXTS = [(1, FILL + "then Ursus ran by Canis lupus."), (2, "Canis first, " + FILL + "Ursus spp. last"), (3, FILL), (4, FILL + "at 51.25 N 121.5 W, " + FILL + "and 52° 30' N, 122° W; " + FILL)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(TEXTS, "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    return at


def test_taxa_anywhere(spark, folder):
    """By brute force: the longest of the three shapes at each known genus."""
    want = sorted((d, m[0]) for d, t in TEXTS for m in re.finditer(r"\b(?:(?:Canis|Ursus) spp?\b\.?|(?:Canis|Ursus) lupus\b|(?:Canis|Ursus)\b)", "Canis lupus and Ursus sp. near " + t))
    got = driver_queries.QUERIES["taxa_in_text"](spark, folder).collect()
    assert sorted((r.doc_id, r["name"]) for r in got) == want
    assert len(want) == 2 * len(TEXTS) + 4


def test_coordinates_anywhere(spark, folder):
    got = driver_queries.QUERIES["coordinates_in_text"](spark, folder).collect()
    want = [(d, *p) for d, _ in TEXTS for p in ((49.504167, -123.25), (50.5, -120.25))] + [(4, 51.25, -121.5), (4, 52.5, -122.0)]
    assert sorted((r.doc_id, r.lat, r.lon) for r in got) == sorted(want)


def test_titles_are_compared_whole(spark, tmp_path):
    texts = [(1, "x" * 70 + "abc" * 20), (2, "a title that is short"), (3, "".join(chr(97 + i * i % 26) for i in range(200)))]
    spark.createDataFrame(texts, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {i: round(difflib.SequenceMatcher(None, t, t[9:], autojunk=False).ratio(), 6) for i, t in texts}
    assert {r.item_id: r.ratio for r in driver_queries.QUERIES["title_similarity"](spark, str(tmp_path)).collect()} == want


def test_taxa_by_tier(spark):
    """Against a walk over each text that claims stretches tier by tier."""
    import random

    from taxaloom.operators import catalogue as cat

    lists = {"genera": ["Canis", "Ursus", "Apis"], "families": ["Felidae"], "higher": ["Aves"], "epithets": ["lupus", "mellifera", "major", "nova-scotia"], "species": ["Canis lupus", "Apis mellifera"]}
    parts = ["Canis", "lupus", "Ursus", "Apis", "mellifera", "sp.", "spp.", "The", "major", "Felidae", "Aves", "Beta", "nova-scotia", "ran", "x", ",", "CanisX", "Canis,", "(Apis"]
    rnd = random.Random(6)
    texts = [(i, " ".join(rnd.choice(parts) + rnd.choice(["", "", " "]) for _ in range(60))) for i in range(40)] + [(90, None), (91, "")]
    have = {k: set(v) for k, v in lists.items()}
    want = set()
    for d, t in texts:
        taken, found = [], {}
        free = lambda m: all(m.end() <= a or m.start() >= b for a, b in taken)
        for m in re.finditer(r"(?<![A-Za-z])([A-Z][a-z]{2,})[ ]+(spp?\.)(?![A-Za-z])", t or ""):
            if m[1] in have["genera"]:
                found.setdefault("genus_qualified", []).append((f"{m[1]} {m[2]}", m[1]))
                taken.append(m.span())
        for m in re.finditer(r"(?<![A-Za-z])([A-Z][a-z]{2,})[ ]+([a-z][a-z-]{2,})(?![A-Za-z])", t or ""):
            pair = f"{m[1]} {m[2]}"
            tier = "species_found" if pair in have["species"] else "species_off_list" if m[2] in have["epithets"] and pair.lower() not in cat.NO_SPECIES else None
            if tier and free(m):
                found.setdefault(tier, []).append((pair, m[1]))
                taken.append(m.span())
        named = {g for x in found.values() for _, g in x}
        for m in re.finditer(r"(?<![A-Za-z])([A-Z][a-z]{2,})(?![A-Za-z])", t or ""):
            kind = next((k for k, s in (("family_found", "families"), ("higher_taxa_found", "higher"), ("genus_bare", "genera")) if m[1] in have[s]), None)
            if kind and free(m) and not (kind == "genus_bare" and m[1] in named):
                found.setdefault(kind, []).append((m[1], m[1]))
        want |= {(d, k, n) for k, x in found.items() for n, _ in x}
    frames = {k: spark.createDataFrame([(x,) for x in v], "name string") for k, v in lists.items()}
    got = [(r.id, r.tier, r["name"]) for r in cat.taxa_tiers(spark.createDataFrame(texts, "id long, text string"), frames).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {k for _, k, _ in want} == {"genus_qualified", "species_found", "species_off_list", "family_found", "higher_taxa_found", "genus_bare"}
