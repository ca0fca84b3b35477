import io
import json
import zipfile

import pytest

from feedloom.plans import datasets
from feedloom.plans.api import Sources
from feedloom.schema import REALTIME, SCHEDULE

from test_catalog_operators import feed, live


def ids(df):
    return sorted(r["mdb_source_id"] for r in df.select("mdb_source_id").collect())


@pytest.fixture(scope="module")
def sources(spark):
    s = spark.createDataFrame([feed("1", features=["pathways"], is_official="True"), feed("2", location=("XB", None, None, None), status="inactive", is_producer_url_unstable="True"), feed("tld-1", urls=("d", 0, None, None, None, None))], SCHEDULE)
    r = spark.createDataFrame([live("11", static_reference=["1", "404"]), live("12"), live("13", static_reference=["2"], features=["pathways"], status="active"), live("2", static_reference=["tld-1"], is_official="True")], REALTIME)
    return Sources(s, r)


def test_questions(sources):
    assert ids(sources.all()) == ["1", "11", "12", "13", "2", "tld-1"] and ids(sources.all("gtfs")) == ["1", "2", "tld-1"]
    assert sources.one("2").first()["data_type"] == "gtfs-rt"
    assert ids(sources.by_country_code("XA")) == ["1", "11", "2", "tld-1"] and ids(sources.by_country_code("XB", "gtfs-rt")) == ["13"]
    assert ids(sources.by_subdivision_name(None)) == ["13", "2"]
    assert ids(sources.by_feature("pathways")) == ["1", "11", "13"]
    assert ids(sources.by_status("active")) == ["1", "11", "12", "13", "2", "tld-1"] and ids(sources.by_status("inactive")) == ["2"]
    assert ids(sources.by_is_official("True")) == ["1", "2"] and ids(sources.by_is_stable("gtfs")) == ["1", "tld-1"]
    assert ids(sources.by_bounding_box(1.5, 9, 3.5, 9)) == ["1", "11", "2", "tld-1"] and ids(sources.by_bounding_box(2, 9, 3.5, 9)) == []
    assert ids(sources.latest_datasets()) == ["1", "2"]
    assert [r["mdb_source_id"] for r in sources.ordered(sources.all()).collect()] == ["1", "2", "11", "12", "13", "tld-1"]
    with pytest.raises(ValueError):
        sources.all("gbfs")


def test_changes(spark, sources):
    patched = sources.updated(spark.createDataFrame([("1", "new", None), ("99", "x", None)], "mdb_source_id string, provider string, status string"), "gtfs")
    assert patched.one("1").first()["provider"] == "new" and len(ids(patched.all())) == 6
    more = sources.with_added(spark.createDataFrame([feed("7")], SCHEDULE), "gtfs")
    assert "7" in ids(more.all("gtfs")) and sources.next_id().first()[0] == 14


def dataset(folder, name, members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for member, text in members.items():
            z.writestr(member, text)
    (folder / f"{name}.zip").write_bytes(buffer.getvalue())


@pytest.fixture(scope="module")
def zips(tmp_path_factory):
    folder = tmp_path_factory.mktemp("zips")
    dataset(folder, "a", {
        "routes.txt": "route_id,route_short_name,route_long_name\nr,1,\n", "feed_info.txt": "feed_contact_email,feed_contact_url\na@b.example,\n",
        "trips.txt": "trip_id,shape_id,block_id\nt1,s1,b\nt2,s1,\n", "frequencies.txt": "trip_id\nt1\nt2\n", "sub/": "",
        "stop_times.txt": "trip_id,shape_dist_traveled,start_service_area_id\nt1,5,x\nt2,1,\n", "shapes.txt": "shape_id,shape_dist_traveled\ns1,2\n",
        "pathways.txt": "pathway_id\np\n", "areas.txt": "area_id\n", "calendar.txt": "end_date\n20240501\n", "stops.txt": "stop_lat,stop_lon\n1,2\n3,4\n",
    })
    dataset(folder, "b", {"routes.txt": "route_id,route_short_name\nr,1\n", "trips.txt": "trip_id,block_id\nt1,b\n", "frequencies.txt": "trip_id\nother\n", "bookings_rules.txt": "h\n1\n2\n3\n", "fares_products.txt": "h\n", "calendar.txt": "end_date\n20200101\nbad\n"})
    return str(folder)


def test_compliance(spark, zips, tmp_path):
    report = tmp_path / "reports" / "a"
    report.mkdir(parents=True)
    (report / "report.json").write_text(json.dumps({"notices": [{"code": "missing_recommended_field", "sampleNotices": [{"filename": "agency.txt", "fieldName": "agency_id"}]}]}, indent=1))
    reports = datasets.read_reports(spark, str(tmp_path / "reports")).withColumnRenamed("report", "dataset_id")
    best, bad = datasets.compliance(datasets.dataset_facts(spark, zips, reports))
    got = {r["dataset_id"]: tuple(r)[1:] for r in best.collect()}
    assert got["a"] == (True, True, False, True, True, True, True, True, True, False, True, True)
    assert got["b"] == (False,) * 12
    assert {tuple(r) for r in bad.collect()} == {("a", True, True), ("b", False, False)}
    packed, counts = datasets.results(best, 12)
    assert packed.count() == 1 and tuple(counts.first()) == (1, 1, 0, 1, 1, 1, 1, 1, 1, 0, 1, 1)


def test_refresh_and_boxes(spark, zips):
    got = {r["dataset_id"]: (r["features"], r["status"]) for r in datasets.refresh(spark, zips, "2024-06-01").collect()}
    assert got == {"a": (["pathways", "flex-v1"], None), "b": (["flex-v2"], "inactive")}
    assert {tuple(r) for r in datasets.bounding_boxes(spark, zips).collect()} == {("a", 1.0, 3.0, 2.0, 4.0), ("b", None, None, None, None)}


def test_sources_are_built_and_updated_from_datasets(spark, zips):
    boxes = datasets.bounding_boxes(spark, zips)
    rows = spark.createDataFrame([("a", "7", "Pró, X", "XA", None, "d7", [(3, None), (None, "x")]), ("gone", "8", "Q", "XA", "S", "d8", None)], "dataset_id string, mdb_source_id string, provider string, country_code string, subdivision_name string, direct_download string, redirect array<struct<id:int,comment:string>>")
    got = datasets.built(rows, boxes, "2024-06-01", "https://h.example/{filename}").collect()
    assert len(got) == 1 and got[0]["file_name"] == "xa-unknown-pro-gtfs-7.json" and got[0]["urls"]["latest"] == "https://h.example/xa-unknown-pro-gtfs-7.zip"
    assert tuple(got[0]["location"]["bounding_box"]) == (1.0, 3.0, 2.0, 4.0, "2024-06-01") and [tuple(x) for x in got[0]["redirect"]] == [("3", None)]
    base = Sources(spark.createDataFrame([feed("1"), feed("2")], SCHEDULE), spark.createDataFrame([], REALTIME))
    patch = spark.createDataFrame([("a", "1", None, "new", "True"), ("gone", "2", "Other", "lost", None)], "dataset_id string, mdb_source_id string, provider string, direct_download string, is_official string")
    after = {r["mdb_source_id"]: r for r in base.updated(datasets.update_patch(patch, boxes, "2024-07-01"), "gtfs").schedule.collect()}
    assert after["1"]["urls"]["direct_download"] == "new" and tuple(after["1"]["location"]["bounding_box"]) == (1.0, 3.0, 2.0, 4.0, "2024-07-01") and after["1"]["provider"] == "P1" and after["1"]["is_official"] == "True"
    assert after["2"]["urls"]["direct_download"] == "https://h.example/d" and after["2"]["location"]["bounding_box"]["extracted_on"] == "t" and after["2"]["provider"] == "Other"
