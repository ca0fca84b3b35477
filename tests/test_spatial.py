import math
import random

from pyspark.sql import functions as F

from feedloom.operators import spatial as s


def km(p, q):
    a, b, c, d = map(math.radians, (*p, *q))
    x = math.sin((a - c) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((b - d) / 2) ** 2
    return 2 * s.EARTH_RADIUS_KM * math.asin(min(1, math.sqrt(x)))


def pairs(spark, points, dist, leaf=s.LEAF_ROWS):
    df = spark.createDataFrame([(i, float(a), float(b), g) for i, (a, b, g) in enumerate(points)], "id long, lat double, lon double, g string")
    return sorted(tuple(r) for r in s.near_pairs(df, "id", F.col("lat"), F.col("lon"), F.col("g"), dist, leaf).collect())


def brute(points, dist):
    n = range(len(points))
    return sorted((i, j) for i in n for j in n if i < j and points[i][2] != points[j][2] and km(points[i][:2], points[j][:2]) <= dist)


def cloud(seed, n, spread):
    rng = random.Random(seed)
    out = []
    for lat, lon in ((0, 0), (51.5, 179.9995), (89.9995, 40), (-89.9998, -100), (33, -180)):
        for _ in range(n):
            a = max(-90, min(90, lat + rng.gauss(0, spread)))
            b = (lon + rng.gauss(0, spread) + 180) % 360 - 180
            out.append((a, b, rng.choice("abcd")))
    return out


def test_everywhere_on_the_sphere(spark):
    points = cloud(1, 60, 0.002)
    assert pairs(spark, points, 0.1) == brute(points, 0.1)


def test_every_level_of_the_tree(spark):
    points = cloud(2, 60, 0.001)
    expected = brute(points, 0.1)
    for leaf in (3, 10, 40):
        assert pairs(spark, points, 0.1, leaf) == expected


def test_crowded_spot_is_accepted_wholesale(spark):
    points = [(10.0, 20.0, "ab"[i % 2]) for i in range(120)]
    assert len(pairs(spark, points, 0.1)) == 60 * 60
    assert pairs(spark, points, 0.1, 25) == brute(points, 0.1)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, "a"), (2, None, 1.0, "b"), (None, 1.0, 1.0, "b"), (3, 1.0, 1.0, None), (4, 1.0, 1.0, "b")], "id long, lat double, lon double, g string")
    run = lambda d: s.near_pairs(d, "id", F.col("lat"), F.col("lon"), F.col("g"), 0.1).collect()
    assert [tuple(r) for r in run(df)] == [(1, 4)] and run(df.limit(0)) == []


def test_boxes(spark):
    rows = [(1.0, 3.0, 170.0, -170.0), (1.0, 3.0, 178.0, -160.0), (0.0, 0.0, 0.0, 0.0), (None, 1.0, 1.0, 1.0), (91.0, 0.0, 0.0, 1.0), (2.0, 1.0, 5.0, 7.0), (1.0, 1.0, -181.0, 0.0), (float("nan"), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    corners = [F.col(x) for x in "abcd"]
    lat, lon = s.box_centre(*corners)
    got = [tuple(r) for r in df.filter(s.usable_box(*corners)).select(lat, lon).collect()]
    assert got == [(2.0, -180.0), (2.0, -171.0), (1.5, 6.0)]


def test_one_group_crowds_a_spot(spark):
    points = [(10.0, 20.0, "hot")] * 90 + [(10.0 + i * 1e-6, 20.0, "hot") for i in range(60)] + [(10.0, 20.0, "b"), (10.0003, 20.0, "c"), (10.1, 20.0, "d")]
    expected = brute(points, 0.1)
    for leaf in (s.LEAF_ROWS, 40, 25):
        assert pairs(spark, points, 0.1, leaf) == expected


def test_two_groups_crowd_a_spot(spark):
    points = [(-5.0 + i * 1e-6, 7.0, "pq"[i % 2]) for i in range(100)] + [(-5.0, 7.0, "r")] * 5
    assert pairs(spark, points, 0.1, 20) == brute(points, 0.1)
