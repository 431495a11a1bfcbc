"""Text as Column expressions: search form, titles, identifiers, keyword masks, markup."""

from __future__ import annotations

import functools
import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Apostrophes that a search form drops.
APOSTROPHES = "['’‘`]"
#: Entities that repaired markup may hold.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def bare(text: str) -> str:
    """A text without accents: canonical decomposition, marks dropped, what is left composed."""
    return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.category(c).startswith("M")))


@functools.lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """All letters with accents and the letters under them; marks on their own, which have nothing under them, come last."""
    points = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    changed = [(c, x) for c in points if (x := bare(c)) != c]
    letters = [(c, x) for c, x in changed if len(x) == 1]
    return "".join(c for c, _ in letters) + "".join(c for c, x in changed if not x), "".join(x for _, x in letters)


def strip_accents(col: Column) -> Column:
    """Letters without their accents."""
    return F.translate(col, *accent_table())


def search_norm(col: Column) -> Column:
    """A name as it is searched: no case, accents, apostrophes or punctuation, and no lone x between words."""
    plain = F.regexp_replace(F.lower(strip_accents(F.coalesce(col, F.lit("")))), APOSTROPHES, "")
    spaced = F.concat(F.lit(" "), F.regexp_replace(plain, "[^a-z0-9]+", " "), F.lit(" "))
    return F.btrim(F.regexp_replace(F.replace(spaced, F.lit(" x "), F.lit(" ")), " +", " "), F.lit(" "))


def search_form(text: str | None) -> str:
    """search_norm of one text that the driver holds, such as a query."""
    plain = re.sub(APOSTROPHES, "", bare(text or "").lower())
    spaced = " " + re.sub("[^a-z0-9]+", " ", plain) + " "
    return re.sub(" +", " ", spaced.replace(" x ", " ")).strip(" ")


def without_subgenus(col: Column) -> Column:
    return F.regexp_replace(col, r"\s*\([^)]*\)", "")


def has_word_starting(padded: Column, phrase: str) -> Column:
    """Whether a search form with a blank before it holds the phrase at the start of a word."""
    return F.contains(padded, F.lit(" " + phrase))


def split_list(col: Column, by: str = ";") -> Column:
    """Trimmed, non-empty parts of a delimited text; null stays null."""
    parts = F.transform(F.split(col, rf"\Q{by}\E", -1), lambda x: F.btrim(x, F.lit(" ")))
    return F.filter(parts, lambda x: x != "")


def normal_doi(col: Column) -> Column:
    """A DOI without resolver, prefix or case; null where there is none."""
    return F.lower(F.nullif(F.regexp_extract(F.coalesce(col, F.lit("")), r"(?i)(10\.[0-9]{4,9}/[^\s\"<>]+?)[.,;)\]}]*(?:\s|$)", 1), F.lit("")))


def normal_title(col: Column) -> Column:
    """A title for exact comparison: lower-case letters and digits, single blanks."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), "[^a-z0-9]+", " "), F.lit(" "))


def trailing_uuid(col: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(F.coalesce(col, F.lit(""))), "([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})$", 1), F.lit(""))


def plural_forms(word: str) -> list[str]:
    """A keyword and the regular plural of its last word."""
    head, _, last = word.rpartition(" ")
    if last.endswith(("s", "x", "z", "ch", "sh")):
        plural = last + "es"
    elif last.endswith("y") and len(last) > 1 and last[-2] not in "aeiou":
        plural = last[:-1] + "ies"
    else:
        plural = last + "s"
    return [word, f"{head} {plural}".strip()]


def quoted(word: str) -> str:
    return rf"\Q{word}\E"


def mask_phrases(col: Column, phrases: list[str]) -> Column:
    """The text with each phrase, whatever its case, as one blank."""
    if not phrases:
        return col
    ordered = sorted(phrases, key=lambda p: (-len(p), p))
    return F.regexp_replace(col, "(?i)(?:" + "|".join(map(quoted, ordered)) + ")", " ")


def has_keyword(col: Column, words: list[str]) -> Column:
    """Whether any word stands in the text with no letter beside it."""
    return col.rlike("(?i)(?<![a-zA-Z])(?:" + "|".join(map(quoted, words)) + ")(?![a-zA-Z])")


def keyword_hits(col: Column, words: list[str]) -> Column:
    """The words that stand in the text, in the order given."""
    found = [F.when(has_keyword(col, plural_forms(w)), F.lit(w)) for w in words]
    return F.array_compact(F.array(*found))


def plain_text(col: Column) -> Column:
    """Markup without scripts, styles, comments and tags; entities read, blanks tidied."""
    bare = F.regexp_replace(col, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    bare = reduce(lambda x, ab: F.replace(x, F.lit(ab[0]), F.lit(ab[1])), ENTITIES, bare)
    return F.btrim(F.regexp_replace(bare, r"[ \t\r\n ]+", " "), F.lit(" "))


def preview(col: Column, length: int = 300) -> Column:
    """The start of a text, cut at a blank, with three dots."""
    cut = F.regexp_replace(F.left(col, F.lit(length)), r" [^ ]*$", "")
    return F.when(F.length(col) <= length, col).otherwise(F.concat(F.rtrim(cut, F.lit(" ,;:.")), F.lit("...")))


def words_of(col: Column, least: int = 4) -> Column:
    return F.regexp_extract_all(F.lower(col), F.lit(f"[a-z]{{{least},}}"), F.lit(0))


def pieces_in_order(text: Column, pieces: list[str]) -> Column:
    """Whether all pieces stand in the text one after another."""
    return text.rlike("(?s)" + ".*".join(map(quoted, pieces)))
