import random

from feedloom.operators import hierarchy as h
from feedloom.operators.skew import Hot, hot_keys


def edges(spark, pairs):
    return h.links(spark.createDataFrame(pairs, "a string, b string"), "a", "b")


def brute(pairs):
    parent = dict(pairs)
    out = {}
    for node in parent:
        seen, at = [node], parent[node]
        while at in parent and at not in seen:
            seen.append(at)
            at = parent[at]
        out[node] = (None, -1) if at in seen else (at, len(seen))
    return out


def test_small_forest_with_loops(spark):
    pairs = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("z", "x"), ("s", "s"), ("q", "a")]
    e = edges(spark, pairs)
    found = h.roots(e)
    assert {r["id"]: (r["root"], r["depth"]) for r in found.collect()} == brute(pairs)
    paths = h.paths(e, found)
    assert {r["id"]: r["path"] for r in paths.collect()} == {"a": ["a", "b", "c"], "b": ["b", "c"], "q": ["q", "a", "b", "c"]}
    assert {(r["ancestor"], r["n_descendants"]) for r in h.descendant_counts(paths).collect()} == {("c", 3), ("b", 2), ("a", 1)}
    assert {tuple(r) for r in h.loop_members(e, found).collect()} == {("x", "x", 2), ("y", "x", 2), ("s", "s", 1)}


def test_random_graphs(spark):
    rng = random.Random(5)
    nodes = [f"n{i}" for i in range(300)]
    pairs = [(n, rng.choice(nodes)) for n in rng.sample(nodes, 270)]
    assert {r["id"]: (r["root"], r["depth"]) for r in h.roots(edges(spark, pairs)).collect()} == brute(pairs)


def test_long_chain_and_star(spark):
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(700)]
    star = [(f"s{i}", "hub") for i in range(500)]
    got = {r["id"]: (r["root"], r["depth"]) for r in h.roots(edges(spark, chain + star)).collect()}
    assert got["c0000"] == ("c0700", 700) and got["s3"] == ("hub", 1)


def test_nulls_repeats_and_empty(spark):
    e = edges(spark, [("a", None), (None, "b"), ("d", "e"), ("d", "e"), ("d", "f")])
    assert [tuple(r) for r in h.roots(e).collect()] == [("d", "e", 1, False)]
    empty = edges(spark, [("a", None)])
    assert h.roots(empty).count() == 0 and h.paths(empty).count() == 0


def test_hot_pointers_are_salted(spark, monkeypatch):
    monkeypatch.setattr("feedloom.operators.skew.HOT_ROWS", 10)
    monkeypatch.setattr(h, "hot_keys", lambda df, key, rows: Hot(["hub"]))
    pairs = [(f"s{i}", "hub") for i in range(300)] + [("hub", "top"), ("a", "s1")]
    assert {r["id"]: (r["root"], r["depth"]) for r in h.roots(edges(spark, pairs)).collect()} == brute(pairs)


def test_hot_keys_go_by_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr("feedloom.operators.skew.HOT_ROWS", 10)
    df = spark.createDataFrame([("a",)] * 95 + [("b",)] * 11 + [("c",)] * 10 + [(None,)] * 50, "k string")
    hot = hot_keys(df, "k", 166)
    assert sorted(hot) == ["a", "b"] and hot.salts == 10
