"""Hexagon cells at four resolutions, as Column expressions.

Points are put on a cylindrical equal-area map and into hexagons of one size for each resolution. Each
resolution has its own origin, so cells of one do not nest in those of another. An id names its
resolution and its place: `h<res>_<q>_<r>`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RADIUS = 6371.0072
#: Average cell areas in square kilometres by resolution.
AREAS = {4: 1770.347654, 5: 252.903858, 6: 36.129062, 7: 5.161293}
#: Origins by resolution, in kilometres on the map.
ORIGINS = {4: (0.37, 0.11), 5: (3.71, 1.93), 6: (1.23, 2.57), 7: (0.71, 0.43)}


def size(res: int) -> float:
    """From the centre of a cell to its corners."""
    return math.sqrt(AREAS[res] * 2 / (3 * math.sqrt(3)))


def cell(lat: Column, lon: Column, res: int) -> Column:
    """The id of the cell at a point; null without a whole point."""
    s, (ox, oy) = size(res), ORIGINS[res]
    x = F.radians(lon) * F.lit(RADIUS) - F.lit(ox)
    y = F.sin(F.radians(lat)) * F.lit(RADIUS) - F.lit(oy)
    q = x * F.lit(math.sqrt(3) / 3 / s) - y * F.lit(1 / 3 / s)
    r = y * F.lit(2 / 3 / s)
    near = lambda v: F.floor(v + F.lit(0.5))
    t = -q - r
    rq, rr, rt = near(q), near(r), near(t)
    dq, dr, dt = F.abs(rq - q), F.abs(rr - r), F.abs(rt - t)
    fq = F.when((dq > dr) & (dq > dt), -rr - rt).otherwise(rq)
    fr = F.when((dq > dr) & (dq > dt), rr).when(dr > dt, -rq - rt).otherwise(rr)
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat(F.lit(f"h{res}_"), fq.cast("string"), F.lit("_"), fr.cast("string")))


def with_cells(df: DataFrame, lat: str, lon: str, names: dict[int, str]) -> DataFrame:
    """df with a cell column for each resolution, step by step: what several steps use is computed once."""
    near = lambda v: F.floor(v + F.lit(0.5))
    out = df.withColumns({"__x": F.radians(lon) * F.lit(RADIUS), "__y": F.sin(F.radians(lat)) * F.lit(RADIUS)})
    steps: list[dict] = [{}, {}, {}]
    for res, name in names.items():
        s, (ox, oy) = size(res), ORIGINS[res]
        x, y = F.col("__x") - F.lit(ox), F.col("__y") - F.lit(oy)
        q, r, rq, rr, rt = (F.col(f"__{v}{res}") for v in ("q", "r", "a", "b", "c"))
        steps[0] |= {f"__q{res}": x * F.lit(math.sqrt(3) / 3 / s) - y * F.lit(1 / 3 / s), f"__r{res}": y * F.lit(2 / 3 / s)}
        t = -q - r
        steps[1] |= {f"__a{res}": near(q), f"__b{res}": near(r), f"__c{res}": near(t)}
        dq, dr, dt = F.abs(rq - q), F.abs(rr - r), F.abs(rt - t)
        first = (dq > dr) & (dq > dt)
        fq, fr = F.when(first, -rr - rt).otherwise(rq), F.when(first, rr).when(dr > dt, -rq - rt).otherwise(rr)
        steps[2][name] = F.concat(F.lit(f"h{res}_"), fq.cast("string"), F.lit("_"), fr.cast("string"))  # null where a coordinate is
    for step in steps:
        out = out.withColumns(step)
    return out.select(*df.columns, *names.values())


def cell_sql(lat: str, lon: str, res: int) -> str:
    """The same as DuckDB SQL."""
    s, (ox, oy) = size(res), ORIGINS[res]
    x, y = f"(radians({lon}) * {RADIUS!r}::DOUBLE - {ox!r}::DOUBLE)", f"(sin(radians({lat})) * {RADIUS!r}::DOUBLE - {oy!r}::DOUBLE)"
    q = f"({x} * {math.sqrt(3) / 3 / s!r}::DOUBLE - {y} * {1 / 3 / s!r}::DOUBLE)"
    r = f"({y} * {2 / 3 / s!r}::DOUBLE)"
    t = f"(-{q} - {r})"
    near = lambda v: f"CAST(floor({v} + 0.5::DOUBLE) AS BIGINT)"
    rq, rr, rt = near(q), near(r), near(t)
    dq, dr, dt = f"abs({rq} - {q})", f"abs({rr} - {r})", f"abs({rt} - {t})"
    first = f"{dq} > {dr} AND {dq} > {dt}"
    fq = f"CASE WHEN {first} THEN -{rr} - {rt} ELSE {rq} END"
    fr = f"CASE WHEN {first} THEN {rr} WHEN {dr} > {dt} THEN -{rq} - {rt} ELSE {rr} END"
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN 'h{res}_' || ({fq}) || '_' || ({fr}) END"


def resolution(cell_id: str) -> int:
    head, _, rest = cell_id.partition("_")
    if not head.startswith("h") or not head[1:].isdigit() or int(head[1:]) not in AREAS or rest.count("_") != 1:
        raise ValueError(f"{cell_id!r} is no cell")
    return int(head[1:])


def _centre(cell_id: str) -> tuple[float, float]:
    res = resolution(cell_id)
    q, r = map(int, cell_id.split("_")[1:])
    s, (ox, oy) = size(res), ORIGINS[res]
    return s * math.sqrt(3) * (q + r / 2) + ox, s * 1.5 * r + oy


def _unproject(x: float, y: float) -> tuple[float, float]:
    return math.degrees(x / RADIUS), math.degrees(math.asin(max(-1.0, min(1.0, y / RADIUS))))


def _project(lon: float, lat: float) -> tuple[float, float]:
    return RADIUS * math.radians(lon), RADIUS * math.sin(math.radians(lat))


def corners(cell_id: str) -> list[tuple[float, float]]:
    """Corners on the map, counter-clockwise."""
    x, y = _centre(cell_id)
    s = size(resolution(cell_id))
    return [(x + s * math.cos(math.radians(60 * k - 30)), y + s * math.sin(math.radians(60 * k - 30))) for k in range(6)]


def outline(cell_id: str) -> list[tuple[float, float]]:
    """(lon, lat) of a cell's corners, counter-clockwise."""
    return [_unproject(*p) for p in corners(cell_id)]


def outline_wkt(cell_id: str) -> str:
    ring = outline(cell_id)
    return "POLYGON((" + ",".join(f"{x:.6f} {y:.6f}" for x, y in [*ring, ring[0]]) + "))"


def inside(point: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    x, y = point
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def _cross(a, b, c, d) -> bool:
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return (side(a, b, c) > 0) != (side(a, b, d) > 0) and (side(c, d, a) > 0) != (side(c, d, b) > 0)


def overlap(a: list[tuple[float, float]], b: list[tuple[float, float]]) -> bool:
    """Whether two rings share any area."""
    if any(inside(p, b) for p in a) or any(inside(p, a) for p in b):
        return True
    return any(_cross(p, q, r, s) for p, q in zip(a, a[1:] + a[:1], strict=True) for r, s in zip(b, b[1:] + b[:1], strict=True))


def cover(ring: list[tuple[float, float]], res: int, most: int = 200_000) -> set[str]:
    """Cells of one resolution that overlap a ring of (lon, lat); more than `most` are refused."""
    flat = [_project(x, y) for x, y in ring]
    s, (ox, oy) = size(res), ORIGINS[res]
    xs, ys = [p[0] for p in flat], [p[1] for p in flat]
    low, high = (math.floor((v - oy) / (1.5 * s)) for v in (min(ys) - s, max(ys) + s))
    found = set()
    for r in range(low, high + 1):
        a, b = (math.floor((v - ox) / (math.sqrt(3) * s) - r / 2) for v in (min(xs) - s, max(xs) + s))
        for q in range(a, b + 2):
            c = f"h{res}_{q}_{r}"
            if overlap(corners(c), flat):
                found.add(c)
                if len(found) > most:
                    raise ValueError(f"the area has more than {most} cells")
    return found
