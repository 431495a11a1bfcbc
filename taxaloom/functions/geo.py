"""Distances, areas and coordinate texts as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The mean radius for distances, and the radius of equal area.
EARTH_KM, AREA_KM = 6371.0, 6371.007180918475


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def box_area_km2(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Area between two meridians and two parallels."""
    return F.lit(AREA_KM * AREA_KM) * F.radians(east - west) * (F.sin(F.radians(north)) - F.sin(F.radians(south)))


def polygon_area_km2(ring: list[tuple[float, float]]) -> float:
    """Area of a ring of (lon, lat) whose sides are straight on the equal-area map."""
    pts = [(math.radians(x), math.sin(math.radians(y))) for x, y in ring]
    twice = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:] + pts[:1], strict=True))
    return abs(twice) / 2 * AREA_KM**2


def fixed(col: Column, places: int = 6) -> Column:
    """A number with so many decimals, halves away from zero."""
    return F.format_string(f"%.{places}f", F.round(col.cast("decimal(38,18)"), places).cast("double"))


def box_wkt(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A closed counter-clockwise ring."""
    w, s, e, n = (fixed(c) for c in (west, south, east, north))
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", *(F.concat_ws(" ", x, y) for x, y in ((w, s), (e, s), (e, n), (w, n), (w, s)))), F.lit("))"))
