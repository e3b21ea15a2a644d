"""Nearest known place against comparing every pair."""

import random

import pytest

from staylake.operators import nearest

POINT, PLACE = "p long, latitude double, longitude double", "place long, latitude double, longitude double"


def _plain(points, places, scale=1.0):
    known = [(i, a, b) for i, a, b in places
             if i is not None and a is not None and b is not None
             and abs(a) < float("inf") and abs(b) < float("inf")]
    out = []
    for p, a, b in points:
        if a is None or b is None or a != a or b != b or not known or abs(a) == float("inf"):
            out.append((p, None, None))
            continue
        d, i = min((((x - a) * (x - a) + ((y - b) * scale) * ((y - b) * scale)), i)
                   for i, x, y in known)
        out.append((p, i, d))
    return sorted(out, key=repr)


def _check(spark, points, places, scale=1.0):
    got = nearest.nearest_place(spark.createDataFrame(points, POINT),
                                spark.createDataFrame(places, PLACE), "place", lon_scale=scale)
    assert sorted(((r["p"], r["place"], r["distance_sq"]) for r in got.collect()),
                  key=repr) == _plain(points, places, scale)


@pytest.mark.parametrize("seed,scale", [(1, 1.0), (2, 0.5)])
def test_equals_all_pairs(spark, seed, scale, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", 4)
    draw = random.Random(seed)
    # one crowded quarter, places far away, repeated and nearly equal coordinates
    places = [(n, 31 + draw.random() * 0.01, -8 + draw.random() * 0.01) for n in range(300)]
    places += [(1000 + n, draw.uniform(-60, 60), draw.uniform(-150, 150)) for n in range(60)]
    places += [(2000, *places[5][1:]), (2001, places[6][1] + 1e-12, places[6][2])]
    points = [(n, draw.uniform(-80, 80), draw.uniform(-170, 170)) for n in range(80)]
    points += [(100 + n, 31 + draw.random() * 0.012, -8 + draw.random() * 0.012) for n in range(80)]
    points += [(300 + n, *places[n][1:]) for n in range(10)] + [(400 + n, 31.0, -8.0) for n in range(50)]
    _check(spark, points, places, scale)


def test_odd_coordinates(spark):
    points = [(1, None, 1.0), (2, float("nan"), 1.0), (3, float("inf"), 1.0), (4, 0.0, 0.0),
              (4, 0.0, 0.0), (None, 1.0, 1.0)]
    _check(spark, points, [(1, 0.0, 0.0), (None, 0.0, 0.0), (2, None, 1.0), (3, 0.0, 0.0)])
    _check(spark, points, [])
    _check(spark, [], [(1, 0.0, 0.0)])
    _check(spark, points, [(n, 1.0, 1.0 + n * 1e-13) for n in range(100)])    # cannot be cut apart
