import duckdb
import pytest

import __spark_entry__ as entry


def test_contract(spark):
    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= names and {"p1_found", "p3_found", "p4_found", "p5_found", "p6_found", "status_default"} <= names
    df = entry.entry(spark)
    assert df.columns == ["feed_row_id", "status"] and df.count() > 0


def shown(v):
    return f"{v:.6f}" if isinstance(v, float) else [shown(x) for x in v] if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, data, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    from pathlib import Path

    for f in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    df = entry.queries()[name](spark, data)
    rel = con.execute(entry.oracle_sql()[name])
    there = [d[0] for d in rel.description]
    assert sorted(there) == sorted(df.columns)
    expected = sorted(repr([shown(r[there.index(c)]) for c in df.columns]) for r in rel.fetchall())
    assert sorted(repr([shown(x) for x in r]) for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, data, name):
    assert entry.queries()[name](spark, data).collect() is not None
