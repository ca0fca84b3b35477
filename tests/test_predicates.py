import pytest
from pyspark.sql import functions as F

from feedloom.functions import predicates as p
from feedloom.functions import text as t


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("a", "b", "c", "d", "expected"),
    [(45, 46, 45.5, 46.5, True), (45, 46, 45.25, 45.75, True), (45.25, 45.75, 45, 46, True), (45, 45.5, 45.5, 46, False), (45.5, 46, 45, 45.5, False), (44, 45, 46, 47.5, False), (None, None, None, None, False)],
)
def test_edges(spark, a, b, c, d, expected):
    lit = lambda x: F.lit(x).cast("double")
    assert value(spark, p.sure(p.overlapping_edges(lit(a), lit(b), lit(c), lit(d)))) is expected


def test_boxes_need_both_axes(spark):
    box = tuple(F.lit(x).cast("double") for x in (43.0, 43.2, -81.5, -81.3))
    assert value(spark, p.overlapping_boxes(box, (43.1, 44.0, -81.4, -80.0))) is True
    assert value(spark, p.overlapping_boxes(box, (43.1, 44.0, -80.0, -79.0))) is False
    assert value(spark, p.overlapping_boxes((F.lit(None).cast("double"), *box[1:]), (43.1, 44.0, -81.4, -80.0))) is False


def test_two_valued_verdicts(spark):
    none = F.lit(None).cast("string")
    assert value(spark, ~p.has_feature(F.lit(None).cast("array<string>"), "x")) is True
    assert value(spark, p.same(none, None)) is True and value(spark, p.same(none, "CA")) is False and value(spark, p.same(F.lit("ca"), "CA")) is False
    assert [value(spark, p.has_status(none, s)) for s in ("active", "inactive", None)] == [True, False, True]
    assert [value(spark, p.has_status(F.lit("inactive"), s)) for s in ("active", "inactive", None)] == [False, True, False]
    assert [value(spark, p.is_stable(c)) for c in (none, F.lit("False"), F.lit("True"))] == [True, True, False]
    assert value(spark, p.status_outside(none)) is True and value(spark, p.status_outside(F.lit("deprecated"))) is False
    assert value(spark, p.has_latest(F.lit("gtfs-rt"), F.lit("u"))) is False and value(spark, p.has_latest(none, F.lit("u"))) is False


def test_redirects_and_addresses(spark):
    r = F.array(*[F.struct(F.lit(i).cast("string").alias("id")) for i in ("1", "None", None)])
    assert value(spark, F.transform(p.usable_redirects(r), lambda x: x["id"])) == ["1"]
    assert [value(spark, p.valid_address(F.lit(x))) for x in ("https://a.org/x", "", "TBD")] == ["https://a.org/x", "", '""']


def test_quantifiers_on_nothing_and_nan(spark):
    df = spark.createDataFrame([], "x string")
    assert tuple(df.agg(p.all_defined(F.col("x")), p.all_undefined(F.col("x")), p.any_defined(F.col("x"))).first()) == (True, True, False)
    assert value(spark, p.number_or_null(F.lit(float("nan")))) is None
    rows = spark.range(1)
    assert tuple(rows.agg(p.at_least_lines(2), p.at_least_lines(3), p.at_least_lines(2, compat=True)).first()) == (True, False, False)


@pytest.mark.parametrize(
    ("text", "expected"),
    [("test", "test"), ("Some Test", "some-test"), ("Some ~Test &!", "some-test"), ("1000 +=+=== Some    ******* ~Test &!", "1000-some-test"), ("SOURCE's test...", "sources-test"), ("SOURCé-çø-čõå-ćō-cåã.", "source-co-coa-co-caa"), ("Source provider,, another, , pro", "source-provider"), ("Straße", "strasse")],
)
def test_normalize(spark, text, expected):
    assert value(spark, t.normalize(F.lit(text))) == expected


def test_other_scripts(spark):
    assert value(spark, t.normalize(F.lit("Київ 12"), other_scripts=True)).endswith("12")


def test_names_and_times(spark):
    lit = F.lit
    assert value(spark, t.filename(lit("CA"), lit("Some Subdivision Name"), lit("Some Provider"), lit("gtfs"), lit("1"), "zip")) == "ca-some-subdivision-name-some-provider-gtfs-1.zip"
    assert value(spark, t.realtime_filename(lit("CA"), lit("unknown"), lit("P"), lit(None).cast("string"), F.array(lit("vp"), lit("tu")), lit("7"))) == "ca-unknown-p-gtfs-rt-vp-tu-7.json"
    assert value(spark, t.iso_time(F.timestamp_seconds(lit(1640995200)))) == "2022-01-01T00:00:00+00:00"
    assert value(spark, t.latest_url(lit("a.zip"), "https://x.example/{filename}?y")) == "https://x.example/a.zip?y"


def test_arrays_and_parsing(spark):
    lit = F.lit
    empty = F.array().cast("array<string>")
    assert [value(spark, t.piped(c)) for c in (F.array(lit("a"), lit("b")), empty, lit(None).cast("array<string>"))] == ["a|b", "[]", None]
    r = F.array(F.struct(lit("1").alias("id"), lit(None).cast("string").alias("comment")), F.struct(lit("2").alias("id"), lit("c").alias("comment")))
    assert value(spark, t.redirect_ids(r)) == "1|2" and value(spark, t.redirect_comments(r)) == "|c"
    assert [str(value(spark, t.gtfs_date(lit(x)))) for x in ("20240229", "20240230", "2024-01-01", "x")] == ["2024-02-29", "None", "None", "None"]
    assert [value(spark, t.whole_number(lit(x), 0)) for x in (" 2 ", "none", "")] == [2, 0, 0] and value(spark, t.whole_number(lit("x"))) is None
    assert value(spark, t.strip(lit("\t a \n"))) == "a"
    assert value(spark, t.base_name(lit("/x/a.b.json"))) == "a.b" and value(spark, t.base_name(lit(".hidden"))) == ".hidden"
    assert value(spark, t.referer(lit("https://h.example:81/p?q"))) == "https://h.example:81" and value(spark, t.referer(lit("not one"))) is None


def test_classification(spark):
    lit = F.lit
    assert [value(spark, t.issue_type(lit(x))) for x in ("NEW SOURCE!", "Source update", "to be removed", "other")] == ["New feed", "Feed update", "removed", "unknown"]
    assert [value(spark, t.data_type(lit(x))) for x in ("Schedule", "Realtime - Trip Updates", "Trip  Updates", "x", "other")] == ["Schedule", "Realtime", "tu", "gu", "gu"]
    assert value(spark, t.data_type(lit("Realtime - Trip Updates"), specific=True)) == "tu"
    assert [value(spark, t.found_date(lit(x))) for x in ("on 1/2/2024.", "2024-11-11", "13/13/2024", "")] == ["01/02/2024", "11/11/2024", "01/01/1970", "01/01/1970"]
    assert value(spark, t.found_date(lit("2024-11-11"), both_forms=False)) == "01/01/1970"
    assert [value(spark, F.transform(t.redirect_list(lit(x)), lambda r: r["id"])) for x in ('"1703 1418"', "12", "")] == [["1703", "1418"], [], None]
    assert value(spark, t.typographic(lit("McGill's\n"))) == "McGillʼs"


def test_recency(spark):
    df = spark.createDataFrame([("20240601",), ("bad",), (None,)], "d string")
    assert df.agg(t.recent(F.col("d"), F.lit("2024-11-01").cast("timestamp"))).first()[0] is True
    assert df.filter("d IS NULL").agg(t.recent(F.col("d"), F.lit("2024-11-01").cast("timestamp"))).first()[0] is False
