"""Areas as text: `b:west,south,east,north` and `p:lon lat,lon lat,...`, several joined by `;`."""

from __future__ import annotations

from fractions import Fraction

MOST_POINTS, MOST_SHAPES = 250, 50


class AreaError(ValueError):
    """A text that is no area."""


def _number(text: str, most: float) -> float:
    try:
        x = float(text)
    except ValueError as e:
        raise AreaError(f"{text!r} is no number") from e
    if not -most <= x <= most:
        raise AreaError(f"{text} is beyond {most:g} degrees")
    return x


def _side(a, b, c) -> int:
    """Which side of the line a-b c lies on, exactly."""
    (ax, ay), (bx, by), (cx, cy) = ([Fraction(x) for x in p] for p in (a, b, c))
    v = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    return (v > 0) - (v < 0)


def _touch(a, b, c, d) -> bool:
    """Whether two sides share a point."""
    s = _side(a, b, c), _side(a, b, d), _side(c, d, a), _side(c, d, b)
    if s[0] != s[1] and s[2] != s[3]:
        return True
    within = lambda p, q, r: min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])
    return any(k == 0 and within(*w) for k, w in zip(s, ((a, b, c), (a, b, d), (c, d, a), (c, d, b)), strict=True))


def crosses_itself(ring: list[tuple[float, float]]) -> bool:
    n = len(ring)
    sides = [(ring[i], ring[(i + 1) % n]) for i in range(n)]
    for i in range(n):
        for j in range(i + 1, n):
            if (j - i) % n in (1, n - 1):
                continue
            if _touch(*sides[i], *sides[j]):
                return True
    return False


def _box(text: str) -> list[tuple[float, float]]:
    parts = text.split(",")
    if len(parts) != 4:
        raise AreaError("a box has four edges")
    w, e = _number(parts[0], 180), _number(parts[2], 180)
    s, n = _number(parts[1], 90), _number(parts[3], 90)
    if w >= e or s >= n:
        raise AreaError("a box's west and south come first; it may not cross the 180 degree line")
    return [(w, s), (e, s), (e, n), (w, n)]


def _polygon(text: str) -> list[tuple[float, float]]:
    ring = []
    for point in text.split(","):
        pair = point.split()
        if len(pair) != 2:
            raise AreaError("a point is a longitude and a latitude")
        ring.append((_number(pair[0], 180), _number(pair[1], 90)))
    if len(ring) > 1 and ring[0] == ring[-1]:
        ring.pop()
    if not 3 <= len(ring) <= MOST_POINTS:
        raise AreaError(f"a polygon has 3 to {MOST_POINTS} points")
    if len(set(ring)) < len(ring) or crosses_itself(ring):
        raise AreaError("a polygon may not cross or touch itself")
    if max(x for x, _ in ring) - min(x for x, _ in ring) > 180:
        raise AreaError("a polygon may not cross the 180 degree line")
    return ring


def read(text: str) -> list[list[tuple[float, float]]]:
    """Rings of (lon, lat)."""
    shapes = [s.strip() for s in text.split(";") if s.strip()]
    if not 1 <= len(shapes) <= MOST_SHAPES:
        raise AreaError(f"an area has 1 to {MOST_SHAPES} shapes")
    out = []
    for s in shapes:
        kind, _, rest = s.partition(":")
        if kind not in ("b", "p"):
            raise AreaError("a shape begins with b: or p:")
        out.append(_box(rest) if kind == "b" else _polygon(rest))
    return out
