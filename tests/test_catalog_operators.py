import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from feedloom.functions import shapes
from feedloom.functions.text import id_order
from feedloom.operators import commands, export, lookup, matrix, merge, ordered, quality
from feedloom.schema import EXPORT_COLUMNS, REALTIME, SCHEDULE

URLS = ("https://h.example/d", 0, None, None, "https://archive.example/1.zip", None)


def feed(i, **kw):
    base = {"mdb_source_id": i, "data_type": "gtfs", "provider": "P" + i, "name": None, "feed_contact_email": None, "features": None, "status": None, "location": ("XA", "Sub", None, (1.0, 2.0, 3.0, 4.0, "t")), "urls": URLS, "redirect": None, "is_official": None, "is_producer_url_unstable": None}
    return tuple((base | kw)[f.name] for f in SCHEDULE.fields)


def live(i, **kw):
    base = {"mdb_source_id": i, "data_type": "gtfs-rt", "entity_type": ["vp"], "provider": " L ", "name": None, "static_reference": None, "note": None, "features": None, "status": None, "urls": URLS, "is_official": None, "is_producer_url_unstable": None, "feed_contact_email": None, "license": None, "redirect": None}
    return tuple((base | kw)[f.name] for f in REALTIME.fields)


@pytest.fixture(scope="module")
def schedule(spark):
    return spark.createDataFrame([feed("1", features=["pathways"]), feed("2", location=("XB", None, None, None)), feed("tld-1", redirect=[("9", None), ("8", "c")])], SCHEDULE)


@pytest.fixture(scope="module")
def realtime(spark):
    return spark.createDataFrame([live("11", static_reference=["1", "404"]), live("12", static_reference=[]), live("13"), live("14", static_reference=["404", "2"], features=["pathways"]), live("15", static_reference=[None, " tld-1 "])], REALTIME)


def test_lookups(schedule, realtime):
    got = {(r[0], r[2], r[3], r[4]) for r in lookup.resolve(realtime, "mdb_source_id", "static_reference", schedule, "mdb_source_id", ["provider"]).collect()}
    assert got == {("11", "1", True, "P1"), ("11", "404", False, None), ("14", "404", False, None), ("14", "2", True, "P2"), ("15", "tld-1", True, "Ptld-1")}
    assert sorted(tuple(r) for r in lookup.dangling(realtime, "mdb_source_id", "static_reference", schedule, "mdb_source_id").collect()) == [("11", "404"), ("14", "404")]
    some = lambda c, own=None: sorted(r[0] for r in lookup.any_reference(realtime, "mdb_source_id", "static_reference", schedule, "mdb_source_id", c, own).select("mdb_source_id").collect())
    assert some(F.col("location.country_code") == "XA") == ["11", "15"]
    assert some(F.array_contains("features", "pathways"), F.array_contains("features", "pathways")) == ["11", "14"]
    first = lookup.first_reference(realtime, "static_reference", schedule.select("mdb_source_id", F.col("location.country_code").alias("country")), "mdb_source_id", "country", F.lit("unknown"))
    assert {r["mdb_source_id"]: r["country"] for r in first.collect()} == {"11": "XA", "12": "unknown", "13": "unknown", "14": None, "15": None}


def test_lookup_plans_are_equi_joins(schedule, realtime):
    df = lookup.any_reference(realtime, "mdb_source_id", "static_reference", schedule, "mdb_source_id", F.col("provider").isNotNull())
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_suffix_match(spark):
    folders = spark.createDataFrame([("a-b-1",), ("c-2",), ("d-2",), ("x-tld-1",), ("plain",), (None,)], "f string")
    ids = spark.createDataFrame([("1",), ("2",), ("tld-1",), ("3",)], "id string")
    # 1 is the suffix of two folders
    assert sorted(tuple(r) for r in lookup.suffix_match(folders, "f", ids, "id").collect()) == [("tld-1", "x-tld-1")]


def test_bounding_boxes(spark):
    stops = spark.createDataFrame([("a", 44.0, -110.0), ("a", 45.0, -109.0), ("a", None, None), ("b", None, 1.0), ("c", float("nan"), 1.0)], "d string, lat double, lon double")
    got = {r[0]: tuple(r)[1:] for r in quality.bounding_boxes(stops, ["d"], F.col("lat"), F.col("lon")).collect()}
    assert got == {"a": (44.0, 45.0, -110.0, -109.0), "b": (None,) * 4, "c": (None,) * 4}
    assert tuple(quality.bounding_boxes(stops.limit(0), [], F.col("lat"), F.col("lon")).first()) == (None,) * 4


def test_exceeded_distance(spark):
    trips = spark.createDataFrame([("t1", "s1"), ("t2", "s2"), ("t3", None), ("t4", "s0"), ("t1", "s1")], "trip_id string, shape_id string")
    stops = spark.createDataFrame([("t1", 5.0), ("t1", 7.0), ("t2", float("nan")), ("t2", 1.0), ("t3", 9.0), ("t4", 1.0)], "trip_id string, shape_dist_traveled double")
    limits = spark.createDataFrame([("s1", 4.0), ("s1", 5.0), ("s2", 2.0), ("s0", 0.0), (None, 1.0)], "shape_id string, shape_dist_traveled double")
    got = {r["trip_id"]: (r["max_stop_times"], r["max_shapes"], r["relative_diff"]) for r in quality.exceeded_distance(trips, stops, limits).collect()}
    assert got == {"t1": (7.0, 5.0, 0.4), "t4": (1.0, 0.0, math.inf)}


def test_all_within(spark):
    left = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("c", None)], "g string, k string")
    right = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "9"), ("c", None)], "g string, r string")
    assert {tuple(r) for r in quality.all_within(left, "k", right, "r", "g").collect()} == {("a", False), ("b", True), ("c", True)}


NOTICES = "array<struct<code:string,sampleNotices:array<struct<filename:string,fieldName:string>>>>"


def test_notices(spark):
    report = [("f", [("routes.txt", "agency_id"), ("x.txt", None)]), ("f", [("other.txt", "later")]), ("g", [("y.txt", None)])]
    df = spark.createDataFrame([(1, report), (2, []), (3, None)], f"id int, n {NOTICES}")
    verdict = lambda *a: [r[0] for r in df.orderBy("id").select(quality.no_notice(F.col("n"), *a)).collect()]
    assert verdict("f", "routes.txt", "agency_id") == [False, True, False]
    assert verdict("f", "x.txt", "agency_id") == [False, True, False]  # two separate conditions
    assert verdict("f", "routes.txt", "other") == [True, True, False]
    assert verdict("f", "other.txt", "later") == [True, True, False]  # only the first notice
    assert verdict("f", "routes.txt", None) == [False, True, False] and verdict("f", None, None) == [True, True, False]
    assert verdict("g", "y.txt", "z") == [False, True, False]


def test_rules_pivot_and_tags(spark):
    wide = spark.createDataFrame([("a", True, False), ("b", True, None), ("c", False, False)], "id string, rule_1 boolean, rule_2 boolean")
    long = quality.verdicts_long(wide, "id", 2).filter("passed")
    assert [tuple(r) for r in quality.packed_columns(long, "id", "rule", ["rule_1", "rule_2"]).orderBy("n").collect()] == [(1, "a", None), (2, "b", None)]
    tags = wide.select("id", quality.feature_tags({"x": F.col("rule_1"), "y": F.col("rule_2")}).alias("t"), quality.derived_status(F.col("rule_2")).alias("s"))
    assert {r["id"]: (r["t"], r["s"]) for r in tags.collect()} == {"a": (["x"], "inactive"), "b": (["x"], "inactive"), "c": (None, "inactive")}
    assert tuple(quality.filled_counts(wide, ["rule_1", "rule_2"]).first()) == (3, 2)


def test_uniqueness_and_contiguity(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert [tuple(r) for r in quality.repeated(ids("1", "1", "2", None, None), "id").collect()] == [("1", 2)]
    assert [quality.contiguous(d, "id").first()[0] for d in (ids("1", "2", "3"), ids("1", "3"), ids("1", "1", "2"), ids("x"), ids())] == [True, False, False, False, True]


def test_patch_merge(spark):
    base = spark.createDataFrame([("1", "gtfs", "P", ("a", 1)), ("2", "gtfs", None, None)], "id string, data_type string, p string, s struct<x:string,y:int>")
    patch = spark.createDataFrame([("1", "other", None, (None, 2), "new"), ("2", None, "Q", ("b", None), None), ("9", "gtfs", "R", None, None)], "id string, data_type string, p string, s struct<x:string,y:int>, extra string")
    assert sorted(tuple(r) for r in merge.patch_merge(base, patch, "id").collect()) == [("1", "gtfs", "P", ("a", 2)), ("2", "gtfs", "Q", ("b", None))]
    assert merge.patch_merge(base, patch.limit(0), "id").count() == 2


def test_unions_and_ids(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), (None, "n")], "id string, v string")
    b = spark.createDataFrame([("2", None, 5)], "id string, v string, w int")
    assert {tuple(r) for r in merge.override_union([a, b], "id").collect()} == {("1", "x", None), ("2", None, 5), (None, "n", None)}
    assert merge.next_id(a, b).first()[0] == 5 and merge.next_id(a, b, key="id").first()[0] == 3
    assert merge.next_id(a.limit(0), key="id").first()[0] == 1
    new = spark.createDataFrame([("2", [("None", "c"), ("7", "c")]), ("3", [("None", "c"), ("7", "c")])], "id string, redirect array<struct<id:string,comment:string>>")
    added = merge.append_entities(a.withColumn("redirect", F.lit(None).cast("array<struct<id:string,comment:string>>")), new, "id").filter("id = '3'").first()
    assert [r["id"] for r in added["redirect"]] == ["7"]


def test_order(spark):
    df = spark.createDataFrame([(i, "v" if i % 7 == 3 else None) for i in range(1, 101)], "id long, v string")
    assert {(r["id"], r["row_no"]) for r in ordered.row_numbers(df, ["id"]).collect()} == {(i, i) for i in range(1, 101)}
    filled = {r["id"]: r["f"] for r in ordered.forward_fill(df.withColumn("v", F.when(F.col("v").isNotNull(), F.col("id").cast("string"))), ["id"], F.col("v"), "f").collect()}
    last = None
    for i in range(1, 101):
        last = str(i) if i % 7 == 3 else last
        assert filled[i] == last
    sizes = [r[1] for r in ordered.chunks(df, ["id"], 8).groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [13, 13, 13, 13, 12, 12, 12, 12]
    assert ordered.chunks(df.limit(3), ["id"]).select("chunk").distinct().count() == 3
    assert ordered.row_numbers(df.limit(0), ["id"]).count() == 0
    ids = spark.createDataFrame([("tld-1",), ("10",), ("9",)], "id string")
    assert [r[0] for r in ids.orderBy(*id_order(F.col("id"))).collect()] == ["9", "10", "tld-1"]


def test_matrix(spark):
    import hashlib

    rows = spark.createDataFrame([(1, "a", 'q"é'), (2, "b", None), (3, "c", "z")], "n int, base string, key string")
    text = matrix.compact_json({"base": F.col("base"), "key": F.col("key")})
    got = matrix.jobs(rows, ["n"], text, 2).orderBy("chunk").collect()
    assert [r["data"] for r in got] == ['{"base":"b"} {"base":"a","key":"q\\"\\u00e9"}', '{"base":"c","key":"z"}']
    assert got[0]["hash"] == hashlib.sha1('{"base":"b"}{"base":"a","key":"q\\"\\u00e9"}'.encode()).hexdigest()
    assert matrix.matrix_json(matrix.jobs(rows, ["n"], text, 2)).first()[0].startswith('{"include":[{"hash":"')
    line = rows.select(matrix.log_line(F.col("base"), F.lit("d"), F.col("key"))).collect()
    assert line[0][0].startswith("a: SUCCESS!") and line[1][0].startswith("b: FAILURE! Direct download URL is d and latest URL is None.")


def test_shapes(spark, schedule):
    flat = shapes.flatten(schedule)
    assert "location.bounding_box.minimum_latitude" in flat.columns
    assert shapes.project(flat, ["mdb_source_id", "none.such"]).columns == ["mdb_source_id", "none.such"]
    with pytest.raises(ValueError):
        shapes.project(flat, ["none.such"], strict=True)
    assert shapes.has_columns(flat, ["urls.latest"]) and not shapes.has_columns(flat, "x")
    out = schedule.limit(1).select(shapes.nested_json(F.struct("mdb_source_id", "name")).alias("j"), shapes.nested_json(F.struct("name"), keep_nulls=True).alias("k")).first()
    assert out["j"] == '{"mdb_source_id":"1"}' and out["k"] == '{"name":null}'


def test_export(schedule, realtime):
    both = merge.override_union([schedule, realtime], "mdb_source_id")
    rows = {r["mdb_source_id"]: r for r in export.export_rows(both, schedule).collect()}
    assert tuple(rows["11"].asDict()) == EXPORT_COLUMNS
    assert rows["11"]["location.country_code"] == "XA" and rows["11"]["static_reference"] == "1|404" and rows["11"]["provider"] == "L"
    assert rows["12"]["location.country_code"] == "unknown" and rows["12"]["static_reference"] == "[]"
    assert rows["14"]["location.country_code"] is None and rows["13"]["location.municipality"] == "unknown"
    assert rows["tld-1"]["redirect.id"] == "9|8" and rows["tld-1"]["redirect.comment"] == "|c" and rows["1"]["features"] == "pathways"


def test_commands(spark):
    from feedloom.sources.form import FORM_FIELDS

    def row(n, **kw):
        return (n, *[kw.get(f, "") for f in FORM_FIELDS])

    rows = [
        row(1, provider="First", datatype="Schedule", issue_type="New source", downloadurl="https://a.org/x", auth_type=" 1", redirects="1703 1418", email="o@a.example"),
        row(2, datatype="Trip Updates", issue_type="Feed update", old_id='"12"'),
        row(3, provider="It's", datatype="Schedule", issue_type="removed", old_id="5"),
        row(4, provider="X", datatype="x", issue_type="other"),
        row(5, provider="Y", datatype="Realtime", issue_type="?", downloadurl="TBD"),
    ]
    df = spark.createDataFrame(rows, "line_id int, " + ", ".join(f"{f} string" for f in FORM_FIELDS))
    calls = commands.call_text(commands.prepared(df, "line_id"), "line_id")
    got = {r["line_id"]: r["command"] for r in calls.collect()}
    assert got[1] == 'add_gtfs_schedule_source(provider="First", direct_download_url="https://a.org/x", authentication_type=1, feed_contact_email="o@a.example", redirects=[{"id": "1703", "comment": " "}, {"id": "1418", "comment": " "}])'
    assert got[2].startswith('update_gtfs_realtime_source(mdb_source_id=12, entity_type=["tu"], provider="TO_BE_PROVIDED (First ?)"')
    assert 'name=""**** issued for removal ****""' in got[3] and "Itʼs" in got[3]
    assert 4 not in got and 'direct_download_url=""""' in got[5]
    assert commands.script(calls, "line_id").first()[0].count("§") == 3


def test_job_objects_are_as_a_json_writer_in_ascii_gives_them(spark):
    rows = [(1, "é \\ \"q\" /", 0, None), (2, "𝄞\t\x01\x7f", 1, None), (3, "plain", None, ""), (4, "日本\r\n", 2, "k")]
    df = spark.createDataFrame(rows, "n int, base string, auth int, key string")
    text = matrix.compact_json({"base": F.col("base"), "key": F.col("key")}, {"key": matrix.key_present(F.col("auth"), F.col("key"))})
    want = [json.dumps({"base": b} | ({"key": k} if a or k else {}), separators=(",", ":")) for _, b, a, k in rows]
    assert [r[0] for r in df.orderBy("n").select(text).collect()] == want
    joined = "".join(reversed(want))
    job = matrix.jobs(df, ["n"], text, 1).first()
    assert job["hash"] == hashlib.sha1(joined.encode()).hexdigest() and job["data"] == joined.replace("}{", "} {")
