"""Secret scans in DataFrame functions alone.

Base rules are regular expressions; matches of a rule are leftmost and non-overlapping, and their
places come from the lengths of matches and of the gaps between them. The entropy rules look at
candidates, maximal runs of a character class that hold a letter and a digit: a window slides over a
candidate with the counts of its characters; the entering and the leaving one change their counts by
one, and with them the sum of c log2 c. Where
the Shannon entropy of a window reaches the class's threshold the window is part of a span. Candidates
on the allow list give none. Entropy spans never replace base spans.

Defined results. A null or empty text has no spans. Places count code points, ends are exclusive; spans
are sorted by start, then in the order of KINDS. Each row stands alone, so repeated rows repeat.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base rules, their kinds in order, and the least length of what must be long.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a failing match leaves no room for a longer one: the length may stand in the rule
HEX = r"[0-9a-f]{16,}"
#: Character classes of the entropy rules: kind, class, shortest candidate, window, threshold in bits.
CLASSES = [("entropy_hex", "0-9a-fA-F", 24, 24, 2.9), ("entropy_base64", "A-Za-z0-9+/_=-", 20, 20, 3.4)]
KINDS = ["assign", "access", "hex", *(c[0] for c in CLASSES)]
#: Candidates that match one of these are no secrets: identifiers, dates, documentation samples, one repeated character.
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}",
    r"(?i)example|placeholder|changeme",
    r"^(.)\1*$",
]
#: Characters of a candidate that one step looks at; longer candidates go in overlapping steps.
STEP = 512

#: Matches of a text that gather at once.
BLOCK = 256

SPAN = "struct<start:bigint,kind:int,end:bigint>"


def _places(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches and gaps: element i of the gaps comes before match i."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _bound(value: Column, body) -> Column:
    """body(value) with the value computed once: a lambda's free expressions are computed at each of its calls."""
    return F.get(F.transform(F.array(value), body), 0)


def _numbers(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _gathered(count: Column, at: Column, item: str, step) -> Column:
    """(end, items): step(place, i, take) for i below count, with the place it starts at; take(end, items) says what comes of it.

    Items gather in blocks, so that a text with very many matches isn't copied once for each.
    """
    none = F.array().cast(f"array<{item}>")

    def block(acc, b):
        first = b * BLOCK
        zero = F.struct(acc["at"].alias("at"), none.alias("out"))
        take = lambda x: lambda end, items: F.struct(end.alias("at"), F.concat(x["out"], items).alias("out"))
        inner = F.aggregate(F.sequence(first, F.least(first + BLOCK, count) - 1), zero, lambda x, i: step(x["at"], i, take(x)))
        return _bound(inner, lambda x: F.struct(x["at"].alias("at"), F.array_append(acc["out"], x["out"]).alias("out")))

    zero = F.struct(at.cast("bigint").alias("at"), F.array().cast(f"array<array<{item}>>").alias("out"))
    return F.aggregate(_numbers(F.ceil(count / F.lit(BLOCK)).cast("int")), zero, block, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["out"]).alias("out")))


def _spans(text: Column, pattern: str, kind: int, keep: int | None = None) -> Column:
    """Spans of the pattern's matches; with keep, of those whose second group has so many characters."""
    matches, gaps = _places(text, pattern)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep else F.lit(None)

    def found(all_: Column) -> Column:
        def step(at, i, take):
            a = at + F.length(F.get(all_["gaps"], i))
            b = a + F.length(F.get(all_["matches"], i))
            span = F.array(F.struct(a.cast("bigint").alias("start"), F.lit(kind).alias("kind"), b.cast("bigint").alias("end")))
            return take(b.cast("bigint"), F.when(F.length(F.get(all_["values"], i)) >= keep, span).otherwise(F.array().cast(f"array<{SPAN}>")) if keep else span)

        return _gathered(F.size(all_["matches"]), F.lit(0), SPAN, step)["out"]

    return _bound(F.struct(matches.alias("matches"), gaps.alias("gaps"), values.alias("values")), found)


def _entropy_spans(text: Column, kind: int, charset: str, shortest: int, window: int, threshold: float) -> Column:
    """Spans of windows of high entropy within candidates of one class."""
    matches, gaps = _places(text, _runs(charset, shortest))
    table = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)))
    least = window * (math.log2(window) - threshold)  # entropy >= threshold as long as the sum of c log2 c is no more
    letters = _members(charset)
    alphabet = "".join(letters)
    empty = F.array().cast(f"array<{SPAN}>")

    def span(a, b):
        return F.struct(a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"))

    def scan(piece: Column, at: Column, f: Column) -> Column:
        """Spans of one piece whose first character stands at `at`."""
        zero = F.struct(F.array_repeat(F.lit(0), len(letters)).alias("c"), F.lit(0.0).alias("s"), F.lit(-1).cast("bigint").alias("a"), F.lit(-1).cast("bigint").alias("b"), empty.alias("out"))

        def step(acc, i):
            # the counts of the entering and the leaving character, by their places in the alphabet, change by one
            place = lambda at: F.instr(F.lit(alphabet), F.substr(piece, at, F.lit(1))) - 1
            old = F.when(i >= window, place(i - window + 1)).otherwise(F.lit(-1))

            def moved(m):
                changed = F.transform(acc["c"], lambda c, k: c + F.when(k == m["new"], 1).otherwise(0) - F.when(k == m["old"], 1).otherwise(0))
                a, b = F.get(acc["c"], m["new"]), F.get(acc["c"], m["old"])
                gain = F.when(m["new"] == m["old"], 0.0).otherwise(F.get(f, a + 1) - F.get(f, a) - F.when(m["old"] >= 0, F.get(f, b) - F.get(f, b - 1)).otherwise(0.0))
                return _bound(acc["s"] + gain, lambda s: after(s, changed))

            def after(s, counts):
                high = (i >= window - 1) & (s <= least + 1e-9)
                start, end = (at + i - window + 1).cast("bigint"), (at + i + 1).cast("bigint")
                more = high & (acc["a"] >= 0) & (start <= acc["b"])
                done = F.when(high & ~more & (acc["a"] >= 0), F.array_append(acc["out"], span(acc["a"], acc["b"]))).otherwise(acc["out"])
                return F.struct(counts.alias("c"), s.alias("s"), F.when(high & ~more, start).otherwise(acc["a"]).alias("a"), F.when(high, end).otherwise(acc["b"]).alias("b"), done.alias("out"))

            return _bound(F.struct(place(i + 1).alias("new"), old.alias("old")), moved)

        return F.aggregate(F.sequence(F.lit(0), F.length(piece) - 1), zero, step, lambda acc: F.when(acc["a"] >= 0, F.array_append(acc["out"], span(acc["a"], acc["b"]))).otherwise(acc["out"]))

    def of(match: Column, at: Column, f: Column) -> Column:
        steps = F.sequence(F.lit(0), F.length(match) - window, F.lit(STEP))
        found = F.flatten(F.transform(steps, lambda o: _bound(F.substr(match, o + 1, F.lit(STEP + window - 1)), lambda piece: scan(piece, at + o, f))))
        joined = F.aggregate(  # spans that overlapping steps have cut are one again
            found,
            empty,
            lambda acc, x: F.when((F.size(acc) > 0) & (x["start"] <= F.get(acc, F.size(acc) - 1)["end"]), F.array_append(F.slice(acc, 1, F.size(acc) - 1), span(F.get(acc, F.size(acc) - 1)["start"], x["end"]))).otherwise(F.array_append(acc, x)),
        )
        held = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
        for pattern in ALLOWED:
            held = held & ~match.rlike(pattern)
        return F.when(held, joined).otherwise(empty)


    def all_spans(all_: Column) -> Column:
        def step(at, i, take):
            a = at + F.length(F.get(all_["gaps"], i))
            m = F.get(all_["matches"], i)
            return take((a + F.length(m)).cast("bigint"), of(m, a, all_["f"]))

        return _gathered(F.size(all_["matches"]), F.lit(0), SPAN, step)["out"]

    return _bound(F.struct(matches.alias("matches"), gaps.alias("gaps"), table.alias("f")), all_spans)


def _members(charset: str) -> list[str]:
    """The characters of a class."""
    return [c for c in map(chr, range(128)) if re.match(f"[{charset}]", c)]


def _runs(charset: str, shortest: int) -> str:
    return rf"(?<![{charset}])[{charset}]{{{shortest},}}"


def scan_text(text: Column) -> tuple[Column, Column]:
    """Base spans and entropy spans of a text: arrays of (start, kind, end), kind by its place in KINDS."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    when = lambda pattern, spans: F.when(text.rlike(pattern), spans).otherwise(none)
    base = F.concat(
        when(ASSIGN, _spans(text, ASSIGN, 0, ASSIGN_LEAST)),
        when(ACCESS, _spans(text, ACCESS, 1)),
        when(HEX, _spans(text, HEX, 2)),
    )
    entropy = F.concat(*(when(_runs(c[1], c[2]), _entropy_spans(text, 3 + i, *c[1:])) for i, c in enumerate(CLASSES)))
    return base, entropy


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, base: str = "base_spans", entropy: str = "entropy_spans") -> DataFrame:
    """docs with two more columns of spans; columns that had these names are replaced."""
    b, e = scan_text(F.col("text"))
    return docs.withColumns({base: b, entropy: e})


def mask(text: Column, spans: Column, by: str = "[SECRET]") -> Column:
    """The text with each span, overlapping ones together, replaced."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        ahead = F.substr(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        return F.when(x["end"] <= acc["at"], acc).otherwise(
            F.struct(x["end"].alias("at"), F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(ahead, F.lit(by)))).otherwise(acc["out"]).alias("out"))
        )

    rest = lambda acc: F.array_join(F.array_append(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))), "")
    return F.when(F.size(spans) > 0, F.aggregate(F.array_sort(spans), zero, step, rest)).otherwise(text)


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    from .common import documents

    out = find_secrets(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    number = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("long")
    return out.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"), F.sha2(as_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), as_text(F.concat("base_spans", "entropy_spans")).alias("spans"))
