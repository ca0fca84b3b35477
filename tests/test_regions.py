import random

import numpy as np
from pyspark.sql import functions as F

from feedloom.operators import regions as r


def rows(seed, n, points):
    rng = random.Random(seed)
    boxes = []
    for i in range(n):
        a, b = rng.choice([(0, 0), (60, 175), (-89, -178)])
        size = rng.choice([0.001, 0.1, 5, 40])
        s = max(-90.0, min(90.0, a + rng.gauss(0, 3)))
        w = (b + rng.gauss(0, 3) + 180) % 360 - 180
        boxes.append((i, s, min(90.0, s + size * rng.random()), w, (w + size * rng.random() + 180) % 360 - 180))
    boxes += [(n, boxes[0][1], boxes[0][2], boxes[0][3], boxes[0][4]), (n + 1, 10.0, -10.0, -20.0, 20.0), (n + 2, 5.0, 5.0, 5.0, 5.0)]
    places = [(i, *rng.choice([(rng.gauss(0, 4), rng.gauss(0, 4)), (60 + rng.gauss(0, 4), (175 + rng.gauss(0, 6) + 180) % 360 - 180), (-90.0, 0.0), (5.0, 5.0)])) for i in range(points)]
    places += [(points + k, b[1], b[3]) for k, b in enumerate(boxes[:20])]
    return boxes, places


def brute(boxes, places):
    out = {}
    for i, lat, lon in places:
        held = []
        for b, s, n, w, e in boxes:
            if min(s, n) <= lat <= max(s, n) and (w <= lon <= e if w <= e else lon >= w or lon <= e):
                held.append((((e - w) if w <= e else e - w + 360) * (max(s, n) - min(s, n)), b))
        out[i] = min(held)[1] if held else None
    return out


def found(spark, boxes, places, at_once=r.BOXES_AT_ONCE):
    b = r.boxes_of(spark.createDataFrame(boxes, "id long, a double, b double, c double, d double"), "id", *map(F.col, "abcd"))
    p = spark.createDataFrame(places, "k long, lat double, lon double")
    return {x["k"]: x["region"] for x in r.containing(p, "k", F.col("lat"), F.col("lon"), b, at_once).collect()}


def test_smallest_box_of_each_point(spark):
    boxes, places = rows(1, 300, 500)
    want = brute(boxes, places)
    assert sum(v is None for v in want.values()) > 10
    assert found(spark, boxes, places) == want


def test_by_cells_in_blocks_and_shares(spark, monkeypatch):
    monkeypatch.setattr(r, "POINTS_AT_ONCE", 40)
    boxes, places = rows(2, 200, 300)
    assert found(spark, boxes, places, 20) == brute(boxes, places)


def test_nodes_are_accepted_wholesale():
    tree = r.BoxTree(np.arange(64), np.full(64, 4.0) + np.arange(64), np.tile([[-1.0, 1.0, -1.0, 1.0]], (64, 1)))
    tree._refine = None  # never reached
    assert (tree.smallest(np.zeros(1000), np.linspace(-1, 1, 1000)) == 0).all()


def test_nulls_and_empty(spark):
    assert found(spark, [(1, 0.0, 1.0, 0.0, 1.0), (None, 0.0, 1.0, 0.0, 1.0), (2, None, 1.0, 0.0, 1.0)], [(1, 0.5, 0.5), (None, 0.5, 0.5), (3, None, 0.5), (4, 9.0, 9.0)]) == {1: 1, 4: None}
    b = r.boxes_of(spark.createDataFrame([], "id long, a double, b double, c double, d double"), "id", *map(F.col, "abcd"))
    p = spark.createDataFrame([(1, 0.0, 0.0)], "k long, lat double, lon double")
    assert [tuple(x) for x in r.containing(p, "k", F.col("lat"), F.col("lon"), b).collect()] == [(1, None)]
    assert r.containing(p.limit(0), "k", F.col("lat"), F.col("lon"), b).count() == 0
