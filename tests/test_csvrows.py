import csv
import io

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.operators.csvrows import split_csv
from feedloom.sources.form import FORM_FIELDS, load_form


def parsed(*lines):
    fields, sound = split_csv(pa.array(lines, pa.string()))
    return list(zip(fields.to_pylist(), sound.tolist(), strict=True))


def test_sound_lines():
    assert parsed("a,b", '"a,b",c', '"a""b",c', '""""', '"a\nb"', '"",""', ",,") == [(["a", "b"], True), (["a,b", "c"], True), (['a"b', "c"], True), (['"'], True), (["a\nb"], True), (["", ""], True), (["", "", ""], True)]


def test_broken_quoting():
    for line in ('a"b', '"a"b,c', '"a" ,b', ' "a",b', '"a,b', '"a""', "a\nb", "a\rb", 'says "closed"', '"says "closed" on",b'):
        assert parsed(line)[0][1] is False, line


def test_null_and_empty_lines_are_one_empty_field():
    assert parsed(None, "") == [([""], True)] * 2
    assert split_csv(pa.array([], pa.string()))[0].to_pylist() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab",\n\r é', max_size=6), min_size=1, max_size=5), min_size=1, max_size=5))
def test_written_rows_are_read_again(rows):
    lines = []
    for r in rows:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(r)
        lines.append(out.getvalue())
    fields, sound = split_csv(pa.array(lines, pa.string()))
    assert sound.all() and fields.to_pylist() == rows


def line(**values):
    return ",".join(values.get(n, "") for n in FORM_FIELDS)


def test_reasons_in_order(spark):
    rows = {
        1: line(provider="Metro", downloadurl="https://a.example/f.zip"),
        2: line(provider="#N/A"),
        3: line(provider="12345"),
        4: line(downloadurl="https://localhost/x.zip"),
        5: line(downloadurl="ftp on request"),
        6: line(note="bad\x07"),
        7: line() + ",",
        8: 'x"y' + line(provider="#REF!"),
        9: None,
        10: "",
        11: line(downloadurl=" http://a-b.c.example:80/p?q#r "),
        12: line(downloadurl="https://a_b.example/f"),
        13: line(downloadurl="https://data x.example/f"),
        14: line(note='"tab\tand ""quotes"""'),
        15: line(provider="Metro", downloadurl="https://a.example"),
        16: line(provider=" ", note="�"),
    }
    df = spark.createDataFrame(list(rows.items()), "line_id int, line string")
    good, bad = load_form(df)
    assert {r["line_id"]: r["reason"] for r in bad.collect()} == {2: "value", 3: "value", 4: "value", 5: "value", 6: "value", 7: "columns", 8: "quoting", 9: "columns", 10: "columns", 12: "value", 13: "value", 16: "value"}
    assert {r["line_id"] for r in good.collect()} == {1, 11, 14, 15}
    assert good.filter("line_id = 14").first()["note"] == 'tab\tand "quotes"'
    assert load_form(df.limit(0))[1].count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, line(provider="Metro"), "b", "x", "y"), (2, "?", "b", "x", "y")], "line_id int, line string, errors string, Provider string, other string")
    good, bad = load_form(df)
    assert good.select("line_id", "provider", "other").collect() == [(1, "Metro", "y")]
    assert bad.select("line_id", "reason", "Provider").collect() == [(2, "columns", "x")]


def test_very_long_line(spark):
    df = spark.createDataFrame([(1, '"' + "x" * 2_000_000 + '"')], "line_id int, line string")
    assert load_form(df)[1].first()["reason"] == "columns"
