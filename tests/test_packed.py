import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.operators.packed import split_packed, unpack


def split(*texts):
    return split_packed(pa.array(texts, pa.string())).to_pylist()


def test_separators_and_quotes():
    assert split("a|b", "a;b", "a, b", "a/b", "a + b", "a & b", "a and b", "a\tb", "a\nb", "a  b") == [["a", "b"]] * 10
    assert split('"x, y" & z') == [["x, y", "z"]]
    assert split('"the ""owl"" lines"; b ') == [['the "owl" lines', "b"]]
    assert split("['a', 'b']", '["a", "b"]', "[ a ]") == [["a", "b"], ["a", "b"], ["a"]]
    assert split("bikes and scooters", '"bikes and scooters"|a') == [["bikes", "scooters"], ["bikes and scooters", "a"]]
    assert split("and", "AND b", "band|andy") == [[], ["b"], ["band", "andy"]]


def test_apostrophes_stay_and_open_quotes_are_ordinary():
    assert split("d'été|l'x") == [["d'été", "l'x"]]
    assert split('"unclosed|b') == [['"unclosed', "b"]]
    assert split("a\xa0b", "é|ü") == [["a", "b"], ["é", "ü"]]


def test_empty_values_dont_count():
    assert split(None, "", "  ", "|;,", '""|a||b;') == [[], [], [], [], ["a", "b"]]
    assert split('" tu "|"vp"') == [["tu", "vp"]]


def test_empty_array_and_long_text():
    assert split_packed(pa.array([], pa.string())).to_pylist() == []
    assert len(split("|".join(["x"] * 200_000))[0]) == 200_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.from_regex(r"[a-z0-9\-]{1,6}", fullmatch=True).filter(lambda x: x != "and"), min_size=1, max_size=5), max_size=6), st.sampled_from("|;,/"))
def test_round_trip(rows, sep):
    assert split_packed(pa.array([sep.join(r) for r in rows], pa.string())).to_pylist() == rows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='ab"\' |,;[]é', max_size=14), max_size=8))
def test_rows_dont_influence_each_other(texts):
    assert split_packed(pa.array(texts, pa.string())).to_pylist() == [split_packed(pa.array([t], pa.string())).to_pylist()[0] for t in texts]


def test_unpack_keeps_key_position_and_repeats(spark):
    df = spark.createDataFrame([(1, "a|b|a", None, "x"), (2, "solo", "p;q", "y"), (None, "m,n", "", "z")], "id int, f string, g string, pos string")
    got = {tuple(r) for r in unpack(df, "id", {"f": F.col("f"), "g": F.col("g")}).collect()}
    assert got == {(1, "f", 1, "a"), (1, "f", 2, "b"), (1, "f", 3, "a"), (2, "g", 1, "p"), (2, "g", 2, "q"), (None, "f", 1, "m"), (None, "f", 2, "n")}
    assert unpack(df.limit(0), "id", {"f": F.col("f")}).count() == 0


def test_whole_column_against_a_pattern(spark, data):
    df = spark.read.parquet(f"{data}/sources.parquet")
    rx = re.compile(r'"(?:[^"]|"")*"|\'[^\']*\'|[^\s|;,/+&"\']+')
    expected = set()
    for r in df.collect():
        body = re.sub(r"^\s*\[(.*)\]\s*$", r"\1", r["features"] or "", flags=re.S)
        items = [m[1:-1].replace('""', '"') if m[0] in "\"'" else m for m in rx.findall(body)]
        items = [i.strip() for i in items if i.strip() and i != "and"]
        if len(items) >= 2:
            expected |= {(r["src_row"], "features", n, i) for n, i in enumerate(items, 1)}
    assert {tuple(r) for r in unpack(df, "src_row", {"features": F.col("features")}).collect()} == expected


def test_pieces_cover_every_row_once():
    from feedloom.operators.bytescan import pieces

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 5, None, "b" * 50, "", "c", "d" * 9])], names=["k", "t"])
    parts = list(pieces(batch, [1], 10))
    assert [p.num_rows for p in parts] == [2, 1, 3] and sum((p.column(0).to_pylist() for p in parts), []) == list(range(6))
    assert list(pieces(batch.slice(0, 0), [1], 10)) == []
