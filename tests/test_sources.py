import io
import json
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from feedloom.operators import quality
from feedloom.schema import REALTIME, SCHEDULE
from feedloom.sources import catalog, gtfs, sinks


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


@pytest.fixture
def folders(tmp_path):
    rt, s = tmp_path / "rt", tmp_path / "s"
    write(rt / "deep", "a b+c-7.json", json.dumps({"mdb_source_id": 7, "static_reference": ["660"], "provider": "é", "redirect": [{"id": 3}], "unknown": 1, "license": "L"}, indent=1))
    write(rt, "twice-8.json", '{"mdb_source_id": 8, "is_official": "False",\n "is_official": "True"}')
    write(rt, "z-8.json", '{"mdb_source_id": 8,\n "provider": "later"}')
    write(s, "1.json", json.dumps({"mdb_source_id": "1", "data_type": "gtfs", "location": {"country_code": "XA", "bounding_box": {"minimum_latitude": 1.5}}, "urls": {"latest": "u"}}, indent=2))
    write(s, "8.json", json.dumps({"mdb_source_id": 8, "provider": "schedule"}))
    return str(s), str(rt)


def test_catalog_files(spark, folders):
    s, rt = folders
    raw = {r["mdb_source_id"]: r for r in catalog.read_realtime(spark, rt, raw=True).collect()}
    assert raw["7"]["file_name"] == "a b+c-7.json" and raw["7"]["static_reference"] == ["660"] and raw["7"]["redirect"][0]["id"] == "3"
    assert raw["8"]["provider"] == "later"
    assert "redirect" not in catalog.read_realtime(spark, rt).columns
    assert catalog.read_schedule(spark, s).filter("mdb_source_id = '1'").first()["location"]["bounding_box"]["minimum_latitude"] == 1.5
    both = {r["mdb_source_id"]: r["provider"] for r in catalog.read_all(spark, s, rt).collect()}
    assert both == {"1": None, "7": "é", "8": "later"}
    flags = catalog.read_json_files(spark, rt, REALTIME, strict=True).filter("file_name = 'twice-8.json'").first()
    assert flags["is_official"] == "True"
    assert catalog.with_base_name(catalog.read_json_files(spark, rt, REALTIME)).filter("mdb_source_id = '7'").first()["base"] == "a b+c-7"
    assert catalog.read_json_files(spark, rt, REALTIME, recursive=False).count() == 2
    assert catalog.readable(catalog.read_schedule(spark, s), ["data_type"]).count() == 1
    assert [r[0] for r in catalog.ordered(catalog.read_all(spark, s, rt)).select("mdb_source_id").collect()] == ["1", "7", "8"]
    assert catalog.read_entity(spark, f"{s}/1.json", SCHEDULE).first()["data_type"] == "gtfs"


def test_csv_lines(spark, tmp_path):
    write(tmp_path / "c", "x.csv", '"a,1",b\nc,"d\ne"\n"f",g\n')
    write(tmp_path / "c", "y+z.csv", "h,i\nj,k\n")
    quoted = catalog.read_csv_lines(spark, str(tmp_path / "c"), ["p", "q"])
    assert {tuple(r) for r in quoted.collect()} == {("a,1", "b", "x.csv", 1), ("c", "d\ne", "x.csv", 2), ("f", "g", "x.csv", 3), ("h", "i", "y+z.csv", 1), ("j", "k", "y+z.csv", 2)}
    assert [r["p"] for r in catalog.row_range(quoted, "2:3").orderBy("p").collect()] == ["c", "f", "j"]
    assert ("h", "i", "y+z.csv", 1) in {tuple(r) for r in catalog.read_csv_lines(spark, f"{tmp_path}/c/y+z.csv", ["p", "q"], naive=True).filter("row_no = 1").collect()}
    with pytest.raises(Exception, match="too few columns"):
        catalog.read_csv_lines(spark, str(tmp_path / "c"), ["p", "q", "r", "s"], naive=True).collect()


def test_rows_of_divided_files_are_numbered_in_order(spark, tmp_path):
    write(tmp_path / "big", "x.txt", "".join(f"line {i},{'z' * (i % 50)}\n" for i in range(1, 20001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        got = catalog.read_csv_lines(spark, str(tmp_path / "big"), ["p", "q"], naive=True)
        assert spark.read.text(f"{tmp_path}/big").rdd.getNumPartitions() > 3 and got.filter(F.col("p") != F.concat(F.lit("line "), "row_no")).count() == 0 and got.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_last_of_each_and_ranges(spark):
    got = catalog.last_of_each(spark.createDataFrame([("a", 1, None), ("a", 3, "x"), ("a", 2, "y"), (None, 9, "z"), ("b", None, "w")], "k string, o int, v string"), "k", "o")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3, "x"), ("b", None, "w")]
    df = spark.range(1, 21).withColumnRenamed("id", "row_no")
    assert catalog.row_range(df, "5").count() == 1 and catalog.row_range(df, "3:10").count() == 8
    with pytest.raises(ValueError):
        catalog.row_range(df, "x")


def dataset(path, members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    path.write_bytes(buffer.getvalue())


@pytest.fixture
def datasets(tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    dataset(folder / "a.zip", {"stops.txt": "﻿stop_id,stop_lat,stop_lon\n1,44,-110\n2,45,-109\n3,NA,\n", "trips.txt": "trip_id,shape_id,block_id\nt1,s1,b\n", "frequencies.txt": "trip_id\nt1\n", "folder/": "", "calendar.txt": "service_id,end_date\nx,20240601\n"})
    dataset(folder / "b.zip", {"stops.txt": 'stop_id,stop_name\n1,"a, b"\n', "empty.txt": ""})
    return str(folder)


def test_datasets(spark, datasets):
    manifest = gtfs.read_manifest(spark, datasets)
    assert manifest.filter("dataset_id = 'b'").count() == 2
    stops = gtfs.read_member(spark, datasets, "stops.txt", {"stop_lat": "double", "stop_lon": "double", "stop_name": "string"})
    assert {(r["dataset_id"], r["has_columns"]) for r in gtfs.with_columns(stops, ["stop_lat", "stop_lon"]).collect()} == {("a", True), ("b", False)}
    boxes = {r[0]: tuple(r)[1:] for r in quality.bounding_boxes(gtfs.data_rows(stops), ["dataset_id"], F.col("stop_lat"), F.col("stop_lon")).collect()}
    assert boxes == {"a": (44.0, 45.0, -110.0, -109.0), "b": (None,) * 4}
    assert gtfs.data_rows(stops).filter("dataset_id = 'b'").first()["stop_name"] == "a, b"
    assert [tuple(r) for r in gtfs.sub_directories(manifest).collect()] == [("a", "folder/")]
    ids = manifest.select("dataset_id").distinct()
    assert {tuple(r) for r in gtfs.members_there(ids, manifest, "trips.txt", "has_trips").collect()} == {("a", True), ("b", False)}
    assert gtfs.read_member(spark, datasets, "nothing.txt", {"x": "string"}).count() == 0


def test_unreadable_datasets_are_rows_of_their_own(spark, datasets):
    with open(f"{datasets}/bad.zip", "wb") as f:
        f.write(b"no zip")
    assert {r[0] for r in gtfs.read_manifest(spark, datasets).collect()} == {"a", "b"}
    assert [(r["dataset_id"], "readable" in r["error"]) for r in gtfs.read_errors(spark, datasets).collect()] == [("bad", True)]
    rows = gtfs.read_members(spark, datasets, ["stops.txt", "trips.txt", "empty.txt"])
    assert {(r["dataset_id"], r["entry_name"], r["n"]) for r in rows.groupBy("dataset_id", "entry_name").agg(F.max("line_no").alias("n")).collect()} == {("a", "stops.txt", 3), ("a", "trips.txt", 1), ("b", "stops.txt", 1), ("b", "empty.txt", 0)}
    assert gtfs.data_rows(gtfs.member_of(rows, "stops.txt", {"stop_lon": "double"})).filter("dataset_id = 'a'").orderBy("line_no").collect()[2]["stop_lon"] is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é ", ("x", None))], "id int, name string, loc struct<a:string,b:string>")
    sinks.write_pretty_json(df, f"{tmp_path}/json", F.concat(F.col("id").cast("string"), F.lit(".json")), F.struct("id", "name", "loc"))
    text = (tmp_path / "json" / "1.json").read_text(encoding="utf-8")
    assert json.loads(text) == {"id": 1, "name": "é ", "loc": {"a": "x"}} and "\n" in text and "é" in text
    sinks.write_csv(df, f"{tmp_path}/csv", ["id", "loc.a", "gone"], strict=False, single=True)
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").columns == ["id", "loc.a", "gone"]
    sinks.write_csv(df, f"{tmp_path}/csv2")
    assert spark.read.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(f"{tmp_path}/csv2").first()["name"] == "é "
    for _ in range(2):
        sinks.write_log(df, f"{tmp_path}/log", F.concat(F.lit("row "), F.col("id").cast("string")))
        sinks.append_block(df, f"{tmp_path}/block", {"id": "number", "name": "label"})
    assert spark.read.text(f"{tmp_path}/log").count() == 2 and spark.read.parquet(f"{tmp_path}/block").columns == ["number", "label"]
    sinks.write_workbook({"Rules & more": df.select("id", "name"), "Count": df.filter("id > 1")}, f"{tmp_path}/book.xlsx")
    with zipfile.ZipFile(f"{tmp_path}/book.xlsx") as z:
        first, names = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")), ElementTree.fromstring(z.read("xl/workbook.xml"))
    assert ["".join(c.itertext()) for c in first.iter() if c.tag.endswith("}c")] == ["id", "name", "1", "é "]
    assert [x.get("name") for x in names.iter() if x.tag.endswith("}sheet")] == ["Rules & more", "Count"]
    sinks.write_sheets({"Rules": df.select("id"), "Count": df.select("name")}, f"{tmp_path}/book")
    sinks.replace_table(df, f"{tmp_path}/block")
    assert spark.read.parquet(f"{tmp_path}/block").count() == 1 and spark.read.option("header", True).csv(f"{tmp_path}/book/Count").count() == 1
