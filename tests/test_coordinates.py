"""Forms of coordinates in texts, with the results that the replaced system's own tests state."""

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import catalogue as cat

POINTS = [
    ("Riske Creek (52.0025°N, 122.4116°W)", [(52.0025, -122.4116)]),
    ("Sidney Island (48°37'39'N, 123°19'30\"W) is", [(48.6275, -123.325)]),
    ("near Satah Mountain (52 o 28'N, 124 o 43'W)", [(52.466667, -124.716667)]),
    ("Latitude 48.3149 N Longitude 126.0580 W Depth 896.1 m", [(48.3149, -126.058)]),
    ("lat: 50.0307, long: −125.0992; bottom", [(50.0307, -125.0992)]),
    ("Stanley Park (49.30275394688415, -123.12643462372476).", [(49.302754, -123.126435)]),
    ("54° North, 130° West", [(54.0, -130.0)]),
    ("GPS 48°50'19.00\"N, 125°08'02.00\"W (48.83861111, -125.13388889)", [(48.838611, -125.133889)]),
    ("-120.4603W, 50.7007N", [(50.7007, -120.4603)]),
    ("Kamloops | -120.4603W | Lac Du Bois Provincial Park | 50.7007N", [(50.7007, -120.4603)]),
    ("below 20°C, 15 N isotopes, a 100 W lamp, 2.5E-3, 1.234, 5.678", []),
]


def rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.c for r in df.select("i", cat.coordinates_in_text(F.col("t")).alias("c")).orderBy("i").collect()]


def test_points(spark):
    got = rows(spark, [t for t, _ in POINTS])
    assert [[(c.lat, c.lon) for c in x] for x in got] == [p for _, p in POINTS]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("the study area (45° N to 58° N and from the coast to 148° W)", [("lat_range", 45, 58, None), ("lon_alone", None, None, -148)]),
        ("Northeast Pacific from 20 to 60°N", [("lat_range", 20, 60, None)]),
        ("31.92N | -33.5N | 26E | -87.85E | -2.33N | 33.75N | -66.5E", [("lat_alone", None, None, 31.92), ("lat_alone", None, None, -33.5), ("lon_alone", None, None, -87.85), ("lat_alone", None, None, -2.33), ("lat_alone", None, None, 33.75), ("lon_alone", None, None, -66.5)]),
    ],
)
def test_ranges_and_halves(spark, text, want):
    assert [(c.kind, c.low, c.high, c.value) for c in rows(spark, [text])[0]] == want


def test_boxes(spark):
    got = rows(spark, ["(-117˚ W to -120˚ W, 53˚ N to 55˚ N)", "Geographic extent West: −139.06°East: −110.43°South: 47.68°North: 60.61° Suggested"])
    assert [[(c.kind, c.s, c.n, c.w, c.e) for c in x] for x in got] == [[("box", 53, 55, -120, -117)], [("box", 47.68, 60.61, -139.06, -110.43)]]


def test_out_of_range_and_null(spark):
    got = rows(spark, ["95.5 N 3.5 E", None, "9.5 N 3.5 E"])
    assert [[c.out_of_range for c in x] for x in got] == [[True], [], [False]]
