import math

import pyarrow as pa
import pytest

from taxaloom.sources import harvest as h

SCHEMA = pa.schema([("id", pa.string()), ("w", pa.float64()), ("k", pa.list_(pa.string()))])
PAGES = {"*": ([{"id": "a", "w": 1.5, "k": ["x"]}, {"id": "b", "w": "NaN"}], "p2"), "p2": ([{"id": "c", "w": None, "k": []}], None)}


def test_stop_and_go_on(spark, tmp_path):
    asked = []

    def fetch(cursor):
        asked.append(cursor)
        if len(asked) == 2:
            raise ConnectionError
        return PAGES[cursor]

    with pytest.raises(ConnectionError):
        h.harvest(str(tmp_path), SCHEMA, fetch)
    with pytest.raises(h.HarvestError):
        h.pages(spark, str(tmp_path), "id string, w double, k array<string>")
    assert h.harvest(str(tmp_path), SCHEMA, fetch) == 3
    assert asked == ["*", "p2", "p2"]
    got = {r.id: r for r in h.pages(spark, str(tmp_path), "id string, w double, k array<string>").collect()}
    assert math.isnan(got["b"].w) and got["c"].w is None and got["c"].k == [] and got["b"].k is None
    assert "NaN" in h.describe(str(tmp_path))


@pytest.mark.parametrize("row", [{"id": 1}, {"id": "a", "w": "1.0"}, {"id": "a", "k": "x"}, {"id": ["a"]}, {"id": "a", "z": 1}])
def test_strict_types(row):
    with pytest.raises((h.HarvestError, pa.ArrowInvalid, pa.ArrowTypeError)):
        h.page_table([row], SCHEMA)


def test_shards():
    assert h.shards(10, 4) == [(0, 4), (4, 8), (8, 10)] and h.shards(0, 4) == []
