"""Addresses and licence texts as they are shown."""

from __future__ import annotations

import html
import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
SEARCH = "https://www.gbif.org/occurrence/search"
CHECKLIST = "7ddf754f-d193-4cc9-b351-99906754a03b"
ACCESS = "info:eu-repo/semantics/"
UNNAMED = "unnamed licence"


def ring_text(ring: list[tuple[float, float]]) -> str:
    """A closed counter-clockwise ring with six decimals."""
    turn = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
    ring = ring if turn > 0 else ring[:1] + ring[:0:-1]
    return "POLYGON((" + ",".join(f"{x:.6f} {y:.6f}" for x, y in [*ring, ring[0]]) + "))"


def search_link(keys: Column, rings: list[list[tuple[float, float]]], years: tuple[int, int] | None = None) -> Column:
    """A search for each row's keys (an array); what is the same in all rows is written and encoded once."""
    from urllib.parse import quote_plus, urlencode

    tail = [("geometry", ring_text(r)) for r in rings] + [("occurrenceStatus", "PRESENT")] + ([("year", f"{years[0]},{years[1]}")] if years else [])
    head = f"{SEARCH}?checklistKey={quote_plus(CHECKLIST)}"
    return F.concat(F.lit(head), F.array_join(F.transform(keys, lambda k: F.concat(F.lit("&taxonKey="), F.url_encode(k))), ""), F.lit("&" + urlencode(tail)))


def display_url(url: Column) -> Column:
    """The middle size of a photo that has sizes; other addresses as they are."""
    return F.regexp_replace(url, r"^(https?://(?:inaturalist-open-data\.s3\.amazonaws\.com|static\.inaturalist\.org)/photos/[0-9]+/)original(\.[A-Za-z]+)", "$1medium$2")


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.links, self.inside = [], [], False

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "br", "div", "li", "ul", "ol", "h1", "h2", "h3", "tr"):
            self.text.append(" ")
        address = dict(attrs).get("href")
        if tag == "a" and address is not None:
            self.links.append([address.strip(), ""])
            self.inside = True

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = False

    def handle_data(self, data):
        self.text.append(data)
        if self.inside:
            self.links[-1][1] += data


def _plain(text: str) -> tuple[str, list]:
    reader = _Links()
    reader.feed(text)
    reader.close()
    return " ".join("".join(reader.text).split()), reader.links


def shown_licence(name: str | None, uri: str | None) -> str | None:
    """A licence as a list shows it: plain text and its address; access rights and placeholders are none. A link that was cut between name and address is joined first."""
    name, uri = name or "", (uri or "").strip()
    if (not name.strip() and uri.startswith(ACCESS)) or (name == "None" and not uri):
        return None
    if re.search(r"<[a-z]", name, re.I) and re.search(r"[<>\"]", uri):
        text, links = _plain(name + uri)
        name, uri = (" ".join(links[0][1].split()), links[0][0]) if links else (text, text if re.match(r"https?://", text) else "")
    text = _plain(name)[0] if "<" in name or "&" in name else " ".join(html.unescape(name).split())
    if not text:
        spdx = re.match(r"https?://spdx\.org/licenses/([^/]+?)(?:\.html)?$", uri)
        text = spdx[1] if spdx else uri or UNNAMED
    return f"{text} ({uri})" if re.match(r"https?://", uri) and uri != text else text


def shown_licences(licences: Column) -> Column:
    """All licences of a record (array of name and uri) as they are shown; texts repeat within a catalogue, so a batch reads each once."""

    @F.pandas_udf("array<string>")
    def read(entries: pd.Series) -> pd.Series:
        known: dict[str, list[str]] = {}
        out = []
        for text in entries:
            if text not in known:
                made = [shown_licence(x.get("name"), x.get("uri")) for x in (json.loads(text) if text else [])]
                known[text] = [m for m in made if m is not None]
            out.append(known[text])
        return pd.Series(out)

    return read(F.to_json(licences))


def picked_resolution(zoom: float, current: int | None, edges: dict[int, float], dead: float = 0.25) -> int:
    """The resolution of a zoom; the one in use stays within `dead` of its edges."""
    fits = max((r for r, z in edges.items() if zoom >= z), default=min(edges))
    if current is None or current == fits:
        return fits
    edge = edges[max(fits, current)]
    return current if abs(zoom - edge) < dead else fits


def pasted_rings(text: str) -> list[list[tuple[float, float]]]:
    """Outer rings of polygons pasted as WKT or GeoJSON."""
    text = text.strip()
    if text.startswith("{"):
        found: list = []

        def walk(x):
            if isinstance(x, dict):
                if x.get("type") == "Polygon":
                    found.append(x["coordinates"][0])
                elif x.get("type") == "MultiPolygon":
                    found.extend(p[0] for p in x["coordinates"])
                else:
                    for v in x.values():
                        walk(v)
            elif isinstance(x, list):
                for v in x:
                    walk(v)

        walk(json.loads(text))
        return [[(float(p[0]), float(p[1])) for p in ring] for ring in found]
    number = r"[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
    bodies = re.findall(r"\(\s*\(([^()]*)\)", text) if re.match(r"(?i)\s*(multi)?polygon", text) else []
    return [[(float(a), float(b)) for a, b in re.findall(rf"({number})\s+({number})", body)] for body in bodies]


def simplified(ring: list[tuple[float, float]], within: float) -> list[tuple[float, float]]:
    """A ring with the points left out that lie within a distance of the line between those kept (Douglas and Peucker)."""

    def keep(a: int, b: int) -> list[int]:
        (x1, y1), (x2, y2) = ring[a], ring[b]
        size = ((x2 - x1) ** 2 + (y2 - y1) ** 2) ** 0.5
        far, at = -1.0, a
        for i in range(a + 1, b):
            x, y = ring[i]
            d = abs((x2 - x1) * (y1 - y) - (x1 - x) * (y2 - y1)) / size if size else ((x - x1) ** 2 + (y - y1) ** 2) ** 0.5
            if d > far:
                far, at = d, i
        return keep(a, at)[:-1] + keep(at, b) if far > within else [a, b]

    if len(ring) < 4:
        return list(ring)
    half = len(ring) // 2
    points = ring
    ring = [*points, points[0]]
    kept = keep(0, half)[:-1] + keep(half, len(points))[:-1]
    return [points[i] for i in kept]


def one_link_for_all(rows: int, link_bytes: int, most: int = 50_000_000, row_bytes: int = 60) -> bool:
    """Whether a file with a link in each row would be too large."""
    return rows * (row_bytes + link_bytes) > most
