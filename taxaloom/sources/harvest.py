"""Harvests that can stop and go on: numbered pages, a cursor, strict field types. Fetching is the caller's."""

from __future__ import annotations

import json
import math
import os
from collections.abc import Callable

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from taxaloom.sources.sinks import read_side_file, side_file


class HarvestError(ValueError):
    """A page that is not as declared."""


def page_table(rows: list[dict], schema: pa.Schema) -> tuple[pa.Table, list[str]]:
    """Rows as a table of declared types; a text "NaN" for a number is kept as NaN, apart from null, and reported."""
    notes, columns = [], []
    for field in schema:
        values = []
        for i, row in enumerate(rows):
            x = row.get(field.name)
            if pa.types.is_floating(field.type) and isinstance(x, str):
                if x != "NaN":
                    raise HarvestError(f"row {i}: {field.name} is {x!r}")
                notes.append(f"row {i}: {field.name} is the text NaN")
                x = math.nan
            if x is not None and pa.types.is_list(field.type) != isinstance(x, list):
                raise HarvestError(f"row {i}: {field.name} is {'a list' if isinstance(x, list) else 'no list'}")
            if x is not None and pa.types.is_string(field.type) and not isinstance(x, str):
                raise HarvestError(f"row {i}: {field.name} is no text")
            values.append(x)
        columns.append(pa.array(values, field.type, from_pandas=False))
    unknown = sorted({k for r in rows for k in r} - set(schema.names))
    if unknown:
        raise HarvestError(f"fields that are not declared: {', '.join(unknown)}")
    return pa.Table.from_arrays(columns, schema=schema), notes


def harvest(folder: str, schema: pa.Schema, fetch: Callable[[str], tuple[list[dict], str | None]], first: str = "*") -> int:
    """Fetch pages from a cursor until there is no next one; each page is a numbered file, written whole or not at all.

    The side file is written after the page: a harvest that stopped in between fetches that page again
    and replaces it.
    """
    os.makedirs(folder, exist_ok=True)
    state_file = os.path.join(folder, "progress.json")
    state = read_side_file(state_file) or {"cursor": first, "pages": 0, "rows": 0, "notes": []}
    while state["cursor"] is not None:
        rows, after = fetch(state["cursor"])
        table, notes = page_table(rows, schema)
        path = os.path.join(folder, f"page-{state['pages']:06d}.parquet")
        pq.write_table(table, path + ".part", compression="zstd")
        os.replace(path + ".part", path)
        state = {"cursor": after if after != state["cursor"] else None, "pages": state["pages"] + 1, "rows": state["rows"] + len(rows), "notes": state["notes"] + notes}
        side_file(state_file, state)
    return state["rows"]


def pages(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All pages of a finished harvest; one that has not ended is refused."""
    state = read_side_file(os.path.join(folder, "progress.json"))
    if not state or state["cursor"] is not None:
        raise HarvestError(f"the harvest in {folder} has not ended")
    rows = spark.read.schema(schema).option("pathGlobFilter", "page-*.parquet").parquet(folder)
    if rows.count() != state["rows"]:
        raise HarvestError(f"{folder} does not hold {state['rows']} rows")
    return rows


def shards(total: int, each: int) -> list[tuple[int, int]]:
    """Offsets of shards that cover all rows once."""
    return [(a, min(a + each, total)) for a in range(0, total, each)]


def describe(folder: str) -> str:
    return json.dumps(read_side_file(os.path.join(folder, "progress.json")), sort_keys=True)
