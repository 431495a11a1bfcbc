"""Licence texts to codes, and whether an image may be shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that mean the Public Domain Mark, in plain form.
PUBLIC_DOMAIN = ["public domain", "public domain mark", "public domain mark 1 0", "pdm", "pdm 1 0", "cc pdm", "cc pdm 1 0"]
#: Codes that can be shown: a code without a version names no licence text.
READABLE = r"CC0_1_0|PDM_1_0|CC_BY(_NC)?(_SA)?(_ND)?_[0-9]+_[0-9]+"
#: Best licence first.
RANKS = ["CC0", "CC_BY", "CC_BY_SA", "CC_BY_ND", "CC_BY_NC", "CC_BY_NC_SA", "CC_BY_NC_ND"]


def _group(text: Column, pattern: str, n: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, n), F.lit(""))


def licence_code(col: Column) -> Column:
    """CC0_1_0, PDM_1_0 or CC_BY with its parts in standard order and the version if one is named; null where unreadable."""
    text = F.lower(F.btrim(F.coalesce(col, F.lit("")), F.lit(" \t\n")))
    plain = F.btrim(F.regexp_replace(text, "[^a-z0-9]+", " "), F.lit(" "))
    url = r"creativecommons\.org/licenses/([a-z-]+)/([0-9]+(?:\.[0-9]+)?)"
    short = r"(?<![a-z0-9])cc[\s_-]+(by(?:[\s_-]+(?:nc|sa|nd))*)(?![a-z0-9])(?:[\s_-]+v?([0-9]+(?:[._][0-9]+)?))?"
    spelled = F.contains(text, F.lit("creative commons")) & F.contains(text, F.lit("attribution"))
    words = F.concat_ws(
        "-", F.lit("by"), F.when(text.rlike(r"non[\s-]?commercial"), F.lit("nc")), F.when(text.rlike(r"share[\s-]?alike"), F.lit("sa")), F.when(text.rlike(r"no[\s-]?deriv"), F.lit("nd"))
    )
    named = F.when(text.rlike(url), _group(text, url)).when(text.rlike(short), _group(text, short)).when(spelled, words)
    version = F.when(text.rlike(url), _group(text, url, 2)).when(text.rlike(short), _group(text, short, 2)).when(spelled, _group(text, r"\b([0-9]\.[0-9])\b"))
    parts = F.split(named, r"[\s_-]+", -1)
    tail = F.slice(parts, 2, 100)
    fine = (F.get(parts, F.lit(0)) == "by") & F.forall(tail, lambda x: x.isin("nc", "sa", "nd")) & ~(F.array_contains(parts, "sa") & F.array_contains(parts, "nd"))
    dotted = F.replace(version, F.lit("_"), F.lit("."))
    dotted = F.when(F.contains(dotted, F.lit(".")), dotted).otherwise(F.concat(dotted, F.lit(".0")))
    has = lambda p: F.when(F.array_contains(parts, p), F.lit(p.upper()))
    code = F.concat_ws("_", F.lit("CC_BY"), has("nc"), has("sa"), has("nd"), F.replace(dotted, F.lit("."), F.lit("_")))
    return (
        F.when(text == "", None)
        .when(F.contains(text, F.lit("publicdomain/zero")) | text.rlike(r"(?<![a-z0-9])cc[\s_-]?0(?![a-z0-9])"), F.lit("CC0_1_0"))
        .when(F.contains(text, F.lit("publicdomain/mark")) | plain.isin(PUBLIC_DOMAIN), F.lit("PDM_1_0"))
        .when(fine, code)
    )


def licence_rank(code: Column) -> Column:
    """The place of a code among RANKS, whatever its version; the Public Domain Mark ranks as CC0; null for others."""
    bare = F.regexp_replace(F.regexp_replace(code, r"_[0-9]+_[0-9]+$", ""), "^PDM$", "CC0")
    return F.nullif(F.array_position(F.array(*map(F.lit, RANKS)), bare), F.lit(0)).cast("int")


def licence_label(code: Column) -> Column:
    """CC_BY_NC_4_0 as `CC BY-NC 4.0`."""
    bare = F.regexp_replace(code, r"_([0-9]+)_([0-9]+)$", " $1.$2")
    bare = F.regexp_replace(bare, "^CC_BY", "CC BY")
    return F.regexp_replace(F.regexp_replace(bare, "^CC0", "CC0"), "_", "-")


def licence_url(code: Column) -> Column:
    version = F.nullif(F.replace(F.regexp_extract(code, r"_([0-9]+_[0-9]+)$", 1), F.lit("_"), F.lit(".")), F.lit(""))
    kind = F.lower(F.replace(F.regexp_extract(code, r"^CC_(BY(?:_[A-Z]{2})*)", 1), F.lit("_"), F.lit("-")))
    return (
        F.when(code == "CC0_1_0", F.lit("https://creativecommons.org/publicdomain/zero/1.0/"))
        .when(code == "PDM_1_0", F.lit("https://creativecommons.org/publicdomain/mark/1.0/"))
        .when(kind != "", F.concat(F.lit("https://creativecommons.org/licenses/"), kind, F.lit("/"), version, F.lit("/")))
    )


def first_text(*cols: Column) -> Column:
    """The first column that holds more than blanks."""
    return F.coalesce(*(F.nullif(F.btrim(c, F.lit(" ")), F.lit("")) for c in cols))


def may_be_shown(url: Column, link: Column, creator: Column, code: Column) -> Column:
    """Image, link to the original, creator and a readable licence are all there; never null."""
    there = first_text(url).isNotNull() & first_text(link).isNotNull() & first_text(creator).isNotNull()
    return there & F.coalesce(code, F.lit("")).rlike(f"^(?:{READABLE})$")
