"""Dataset runs as queries: zips are made from the tables, one a nation, and then read, judged and put in the catalog.

What stands in the zips follows from the keys by a rule, so SQL on the tables gives the same answers.
"""

from __future__ import annotations

import os
import uuid
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table
from ..sources import gtfs
from . import datasets
from .catalog import NOW, _normal_sql

_MADE: dict[tuple[str, str], str] = {}
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _members(nation: int, keys: list[int], balances: list[float]) -> dict[str, str]:
    """The texts of a nation's members; ``keys`` and ``balances`` of its customers."""
    lines = lambda header, rows: "".join(f"{x}\n" for x in (header, *rows))
    out = {
        "stops.txt": lines("stop_id,stop_lat,stop_lon", (f"{k},{b / 100!r},{k % 360 - 180}" for k, b in zip(keys, balances, strict=True))),
        "routes.txt": lines("route_id,route_short_name,route_long_name", (f"{k},R{k},{'' if nation % 2 else f'Line {k}'}" for k in keys)),
        "feed_info.txt": lines("feed_contact_email,feed_contact_url", [f"{'a@b.example' if nation % 3 == 0 else ''},{'http://b.example' if nation % 3 == 2 else ''}"]),
        "trips.txt": lines("trip_id,shape_id,block_id", (f"{k},s{k % 5},b" for k in keys)),
        "frequencies.txt": lines("trip_id", (str(k) for k in keys if nation % 4 == 0 or k % 2)),
        "stop_times.txt": lines("trip_id,shape_dist_traveled", (f"{k},{k % 7 + 1}" for k in keys)),
        "shapes.txt": lines("shape_id,shape_dist_traveled", (f"s{i},{0.5 if nation % 5 == 0 else 100}" for i in range(5))),
        "calendar.txt": lines("service_id,end_date", ["x,20240301" if nation % 2 else "x,20200101"]),
        "pathways.txt": lines("pathway_id", ["p"] * (nation % 3)),
        "fares_products.txt": lines("fare_product_id", ["p"] * (nation % 2)),
    }
    return out | ({"sub/": ""} if nation % 6 == 0 else {})


def made(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the zips, in the session's shared folder; made once a session and table folder. One zip can't be read."""
    known = _MADE.get((spark.sparkContext.applicationId, sf_dir))
    if known:
        return known
    customers = cut(table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("int").alias("nation"), F.col("c_custkey").cast("long").alias("key"), F.col("c_acctbal").cast("double").alias("balance")))
    folder = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/zips-{uuid.uuid4().hex}"

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        nation = int(rows["nation"].iloc[0])
        os.makedirs(folder, exist_ok=True)
        part = f"{folder}/.{nation}-{uuid.uuid4().hex}"
        with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in _members(nation, rows["key"].tolist(), rows["balance"].tolist()).items():
                z.writestr(name, text)
        os.replace(part, f"{folder}/n{nation}.zip")  # a repeated task writes the same again
        if nation == 0:
            with open(f"{folder}/broken.zip", "wb") as f:
                f.write(b"no zip")
        return pd.DataFrame({"nation": [nation]})

    customers.groupBy("nation").applyInPandas(write, "nation int").collect()
    _MADE[spark.sparkContext.applicationId, sf_dir] = folder
    return folder


def query(sql: str) -> Callable:
    def note(f: Callable) -> Callable:
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return note


_N = "WITH c AS (SELECT c_nationkey AS n, c_custkey AS k, CAST(c_acctbal AS DOUBLE) / 100 AS lat, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon FROM customer), b AS (SELECT n, min(lat) AS minimum_latitude, max(lat) AS maximum_latitude, min(lon) AS minimum_longitude, max(lon) AS maximum_longitude, bool_or(k % 2 = 0) AS even FROM c GROUP BY n) "


@query("SELECT DISTINCT 'n' || c_nationkey AS dataset_id, m AS entry_name FROM customer, unnest(['stops.txt', 'routes.txt', 'feed_info.txt', 'trips.txt', 'frequencies.txt', 'stop_times.txt', 'shapes.txt', 'calendar.txt', 'pathways.txt', 'fares_products.txt', 'sub/']) AS u(m) WHERE m <> 'sub/' OR c_nationkey % 6 = 0")
def dataset_manifest(spark, sf_dir):
    return gtfs.read_manifest(spark, made(spark, sf_dir))


@query("SELECT 'broken' AS dataset_id, true AS reported")
def dataset_errors(spark, sf_dir):
    return gtfs.read_errors(spark, made(spark, sf_dir)).select("dataset_id", F.col("error").isNotNull().alias("reported"))


@query("SELECT 'n' || c_nationkey AS dataset_id, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS line_no, c_custkey AS trip_id, 's' || c_custkey % 5 AS shape_id FROM customer")
def dataset_lines(spark, sf_dir):
    trips = gtfs.read_member(spark, made(spark, sf_dir), "trips.txt", {"trip_id": "bigint", "shape_id": "string"})
    return gtfs.data_rows(trips).select("dataset_id", "line_no", "trip_id", "shape_id")


@query(_N + "SELECT 'n' || n AS dataset_id, minimum_latitude, maximum_latitude, minimum_longitude, maximum_longitude FROM b")
def dataset_boxes(spark, sf_dir):
    return datasets.bounding_boxes(spark, made(spark, sf_dir))


@query(_N + "SELECT 'n' || n AS dataset_id, n % 2 = 1 AS rule_1, " + ", ".join(f"false AS rule_{i}" for i in (2, 3, 4, 5, 6, 7, 8, 11)) + ", n % 3 = 0 AS rule_9, n % 3 = 2 AS rule_10, n % 4 = 0 OR NOT even AS rule_12 FROM b")
def dataset_best_practices(spark, sf_dir):
    """Without a validator's report, the rules that need one fail."""
    return datasets.compliance(datasets.dataset_facts(spark, made(spark, sf_dir)))[0]


@query("SELECT DISTINCT 'n' || c_nationkey AS dataset_id, c_nationkey % 6 = 0 AS rule_1, c_nationkey % 5 = 0 AS rule_2 FROM customer")
def bad_practice_rules(spark, sf_dir):
    return datasets.compliance(datasets.dataset_facts(spark, made(spark, sf_dir)))[1]


@query("SELECT DISTINCT 'n' || c_nationkey AS dataset_id, nullif(list_filter([CASE WHEN c_nationkey % 3 > 0 THEN 'pathways' END, CASE WHEN c_nationkey % 2 > 0 THEN 'fares-v2' END], lambda x: x IS NOT NULL), []) AS features, CASE WHEN c_nationkey % 2 = 0 THEN 'inactive' END AS status FROM customer")
def dataset_refresh(spark, sf_dir):
    return datasets.refresh(spark, made(spark, sf_dir), NOW)


_NAMED = "concat_ws('-', " + _normal_sql("'XA'") + ", 'unknown', " + _normal_sql("n_name") + ", 'gtfs', n_nationkey)"


@query(_N + f"SELECT CAST(n_nationkey AS VARCHAR) AS mdb_source_id, n_name AS provider, minimum_latitude, maximum_longitude, '{NOW}' AS extracted_on, 'https://archive.example/' || {_NAMED} || '.zip' AS latest, {_NAMED} || '.json' AS file_name FROM nation JOIN b ON n = n_nationkey")
def dataset_sources(spark, sf_dir):
    """Schedule sources of the nations, built from their datasets."""
    key = F.col("n_nationkey").cast("string")
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), key).alias("dataset_id"), key.alias("mdb_source_id"), F.col("n_name").alias("provider"), F.lit("XA").alias("country_code"))
    found = datasets.built(rows, datasets.bounding_boxes(spark, made(spark, sf_dir)), NOW, "https://archive.example/{filename}")
    return found.select("mdb_source_id", "provider", "location.bounding_box.minimum_latitude", "location.bounding_box.maximum_longitude", "location.bounding_box.extracted_on", "urls.latest", "file_name")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
