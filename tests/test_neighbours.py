"""Stations near each other: any lie of the stations, full cells in parts."""

import math
import random

import pytest

from skyledger.operators import neighbours as NB


def km(a, b):
    y, v = map(math.radians, (a[1], b[1]))
    h = math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("radius", [2.0, 150.0, 3000.0])
def test_pairs_of_full_cells_at_poles_and_date_line(spark, monkeypatch, radius):
    monkeypatch.setattr(NB, "PART_ROWS", 3)
    draw = random.Random(8)
    made = [(i, 50.0 + draw.random() / 50, 1.0 + draw.random() / 50) for i in range(30)]
    made += [(100 + i, draw.choice([-90.0, 90.0, 89.7, -89.9]), draw.uniform(-180, 180)) for i in range(15)]
    made += [(200 + i, draw.uniform(-3, 3), draw.choice([-180.0, 180.0, 179.9, -179.8])) for i in range(25)]
    stations = spark.createDataFrame(made, "station_id long, latitude double, longitude double")
    found = NB.station_neighbours(stations, radius)
    got = {(r.station_id, r.other_id): r.distance_km for r in found.collect()}
    expected = {(a[0], b[0]): km(a, b) for a in made for b in made if a[0] < b[0] and km(a, b) <= radius}
    assert got.keys() == expected.keys() and len(got) == found.count()
    assert all(abs(got[k] - expected[k]) < 1e-6 for k in got)
