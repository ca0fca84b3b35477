"""Queries of the catalog, dataset and form operators over whole tables, each with its SQL.

Every entry is one function, named like its query, with the SQL in its ``sql`` attribute.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as pr
from ..functions import shapes
from ..functions import text as tx
from ..operators import commands, export, lookup, matrix, merge, ordered, quality
from ..operators.csvrows import parse_lines
from ..session import table
from ..sources.catalog import last_of_each, naive_cells, row_range
from ..sources.form import FORM_FIELDS, load_form
from .api import Sources
from .problems import PARSED_FORM

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

NOW = "2024-06-01 00:00:00"
BOX = (-10.0, 20.0, 30.0, 140.0)


def query(sql: str | None = None) -> Callable:
    def note(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return note


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "schedule_feeds")


def realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "realtime_feeds")


def latest_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each id: the last to arrive."""
    return last_of_each(schedule(spark, sf_dir), "mdb_source_id", F.struct("loaded_at", "feed_row_id"))


def latest_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_of_each(realtime(spark, sf_dir), "mdb_source_id", F.struct("loaded_at", "rt_row_id"))


_LATEST = """
WITH s AS (SELECT * FROM schedule_feeds WHERE mdb_source_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY mdb_source_id ORDER BY loaded_at DESC, feed_row_id DESC) = 1),
r AS (SELECT * FROM realtime_feeds WHERE mdb_source_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY mdb_source_id ORDER BY loaded_at DESC, rt_row_id DESC) = 1)
"""
_REFS = _LATEST + ", refs AS (SELECT rt_row_id, trim(ref) AS ref, CAST(pos - 1 AS INTEGER) AS position FROM (SELECT rt_row_id, unnest(static_reference) AS ref, generate_subscripts(static_reference, 1) AS pos FROM realtime_feeds) WHERE ref IS NOT NULL)"


# Filters.
@query("SELECT feed_row_id, status FROM schedule_feeds WHERE status = 'active' OR status IS NULL")
def status_default(spark, sf_dir):
    return schedule(spark, sf_dir).filter(pr.has_status(F.col("status"), "active")).select("feed_row_id", "status")


@query("SELECT feed_row_id FROM schedule_feeds WHERE status IS NOT DISTINCT FROM NULL")
def status_none(spark, sf_dir):
    return schedule(spark, sf_dir).filter(pr.has_status(F.col("status"), None)).select("feed_row_id")


@query("SELECT feed_row_id FROM schedule_feeds WHERE location.country_code = 'XA'")
def country_eq(spark, sf_dir):
    return schedule(spark, sf_dir).filter(pr.same(F.col("location.country_code"), "XA")).select("feed_row_id")


@query("SELECT feed_row_id FROM schedule_feeds WHERE location.subdivision_name IS NOT DISTINCT FROM NULL")
def subdivision_none(spark, sf_dir):
    return schedule(spark, sf_dir).filter(pr.same(F.col("location.subdivision_name"), None)).select("feed_row_id")


@query("SELECT feed_row_id, is_official IS NOT DISTINCT FROM 'True' AS official, is_official IS NULL AS unsaid FROM schedule_feeds")
def official_eq(spark, sf_dir):
    return schedule(spark, sf_dir).select("feed_row_id", pr.same(F.col("is_official"), "True").alias("official"), pr.same(F.col("is_official"), None).alias("unsaid"))


@query("SELECT feed_row_id FROM schedule_feeds WHERE is_producer_url_unstable = 'False' OR is_producer_url_unstable IS NULL")
def stable_url(spark, sf_dir):
    return schedule(spark, sf_dir).filter(pr.is_stable(F.col("is_producer_url_unstable"))).select("feed_row_id")


@query("SELECT feed_row_id, coalesce(list_contains(features, 'fares-v2'), false) AS has FROM schedule_feeds")
def feature_contains(spark, sf_dir):
    return schedule(spark, sf_dir).select("feed_row_id", pr.has_feature(F.col("features"), "fares-v2").alias("has"))


@query("SELECT mdb_source_id, urls.latest AS latest FROM schedule_feeds WHERE urls.latest IS NOT NULL AND data_type = 'gtfs'")
def latest_datasets(spark, sf_dir):
    rows = schedule(spark, sf_dir)
    return rows.filter(pr.has_latest(F.col("data_type"), F.col("urls.latest"))).select("mdb_source_id", F.col("urls.latest").alias("latest"))


@query(f"""SELECT feed_row_id, coalesce(b.maximum_latitude > {BOX[0]} AND {BOX[1]} > b.minimum_latitude AND b.maximum_longitude > {BOX[2]} AND {BOX[3]} > b.minimum_longitude, false) AS overlaps
FROM (SELECT feed_row_id, location.bounding_box AS b FROM schedule_feeds)""")
def bbox_overlap(spark, sf_dir):
    b = [F.col(f"location.bounding_box.{n}") for n in ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude")]
    return schedule(spark, sf_dir).select("feed_row_id", pr.overlapping_boxes(tuple(b), BOX).alias("overlaps"))


@query("SELECT * FROM schedule_feeds WHERE mdb_source_id = '1010'".replace("*", "feed_row_id, provider"))
def point_lookup(spark, sf_dir):
    return schedule(spark, sf_dir).filter(pr.same(F.col("mdb_source_id"), "1010")).select("feed_row_id", "provider")


@query(r"""SELECT line_id, CASE WHEN f <> '' AND NOT regexp_matches(f, 'https?://(www\.)?[-a-zA-Z0-9@:%._+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b([-a-zA-Z0-9()@:%_+.~#?&/=]*)') THEN '""' ELSE f END AS address
FROM (SELECT line_id, regexp_replace(string_split(line, ',')[7], '^\s+|\s+$', '', 'g') AS f FROM form_lines)""")
def address_check(spark, sf_dir):
    cell = F.get(F.split("line", ","), F.lit(6))
    return table(spark, sf_dir, "form_lines").select("line_id", pr.valid_address(tx.strip(cell)).alias("address"))


# Projections.
@query("""SELECT feed_row_id, mdb_source_id, location.country_code AS "location.country_code", location.bounding_box.minimum_latitude AS "location.bounding_box.minimum_latitude", urls.latest AS "urls.latest", NULL::VARCHAR AS "no.such" FROM schedule_feeds""")
def flatten_project(spark, sf_dir):
    return shapes.project(shapes.flatten(schedule(spark, sf_dir)), ["feed_row_id", "mdb_source_id", "location.country_code", "location.bounding_box.minimum_latitude", "urls.latest", "no.such"])


@query("SELECT r_regionkey AS region_id, r_name AS region, 'tpch' AS origin, 'rule_' || row_number() OVER (ORDER BY r_regionkey) AS rule_id FROM region")
def rename_stamp(spark, sf_dir):
    rows = ordered.row_numbers(shapes.rename(table(spark, sf_dir, "region"), {"r_regionkey": "region_id", "r_name": "region"}), ["region_id"])
    return shapes.stamp(rows, "origin", "tpch").withColumn("rule_id", F.concat(F.lit("rule_"), "row_no")).drop("row_no")


@query("SELECT feed_row_id, 'mdb_source_id: ' || coalesce(mdb_source_id, '-') || '; provider: ' || coalesce(provider, '-') || '; status: ' || coalesce(status, '-') AS described FROM schedule_feeds")
def row_description(spark, sf_dir):
    return schedule(spark, sf_dir).select("feed_row_id", shapes.described(["mdb_source_id", "provider", "status"]).alias("described"))


@query()
def renested_json(spark, sf_dir):
    rows = schedule(spark, sf_dir)
    flat = {c.split(".")[-1]: F.col(c) for c in ("mdb_source_id", "data_type", "provider", "name", "feed_contact_email", "features", "status", "location.country_code", "location.subdivision_name", "location.municipality", "location.bounding_box.minimum_latitude", "location.bounding_box.maximum_latitude", "location.bounding_box.minimum_longitude", "location.bounding_box.maximum_longitude", "location.bounding_box.extracted_on", "urls.direct_download", "urls.authentication_type", "urls.authentication_info", "urls.api_key_parameter_name", "urls.latest", "urls.license", "redirect", "is_official", "is_producer_url_unstable")}
    return rows.select("feed_row_id", shapes.nested_json(shapes.schedule_struct(flat)).alias("json"))


# Scalars.
_ACCENTS, _PLAIN = tx._ACCENTED, tx._PLAIN
_NORMAL = "translate(replace(replace(replace(replace(replace(regexp_replace(trim(regexp_replace(lower(split_part({0}, ',', 1)), '[^\\p{{L}}\\p{{N}} \\-]', '', 'g')), ' +', '-', 'g'), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), 'þ', 'th'), 'ð', 'd'), '" + _ACCENTS + "', '" + _PLAIN + "')"


def _normal_sql(c: str) -> str:
    return _NORMAL.format(c)


@query(f"SELECT place_id, {_normal_sql('municipality')} AS normal FROM places")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "places").select("place_id", tx.normalize(F.col("municipality")).alias("normal"))


@query(f"""SELECT feed_row_id, name, 'https://archive.example/' || name || '?alt=media' AS latest FROM (SELECT feed_row_id, concat_ws('-', {_normal_sql("coalesce(location.country_code, 'None')")}, {_normal_sql("coalesce(location.subdivision_name, 'None')")}, {_normal_sql("coalesce(provider, 'None')")}, data_type, mdb_source_id) || '.zip' AS name FROM schedule_feeds)""")
def file_names(spark, sf_dir):
    rows = schedule(spark, sf_dir)
    named = rows.select("feed_row_id", tx.filename(F.col("location.country_code"), F.col("location.subdivision_name"), F.col("provider"), F.col("data_type"), F.col("mdb_source_id"), "zip").alias("name"))
    return named.withColumn("latest", tx.latest_url(F.col("name"), "https://archive.example/{filename}?alt=media"))


@query(_LATEST + f""", p AS (SELECT t.rt_row_id, t.name, t.provider, t.entity_type, t.mdb_source_id, CASE WHEN coalesce(len(t.static_reference), 0) = 0 THEN 'unknown' ELSE s.location.country_code END AS c, CASE WHEN coalesce(len(t.static_reference), 0) = 0 THEN 'unknown' ELSE s.location.subdivision_name END AS d
FROM realtime_feeds t LEFT JOIN s ON trim(t.static_reference[1]) = s.mdb_source_id)
SELECT rt_row_id, concat_ws('-', {_normal_sql("coalesce(c, 'None')")}, {_normal_sql("coalesce(d, 'None')")}, {_normal_sql('coalesce(name, provider)')}, 'gtfs-rt-' || array_to_string(entity_type, '-'), mdb_source_id) || '.json' AS name FROM p""")
def realtime_file_names(spark, sf_dir):
    """By the country and subdivision of the first static row."""
    unknown = F.struct(F.lit("unknown").alias("country_code"), F.lit("unknown").alias("subdivision_name"))
    places = latest_schedule(spark, sf_dir).select("mdb_source_id", F.struct("location.country_code", "location.subdivision_name").alias("place"))
    rows = lookup.first_reference(realtime(spark, sf_dir), "static_reference", places, "mdb_source_id", "place", unknown)
    return rows.select("rt_row_id", tx.realtime_filename(F.col("place.country_code"), F.col("place.subdivision_name"), F.col("provider"), F.col("name"), F.col("entity_type"), F.col("mdb_source_id")).alias("name"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM events")
def iso_times(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.iso_time(F.col("ts")).alias("iso"))


@query("""SELECT feed_row_id, CASE WHEN len(features) > 0 THEN array_to_string(features, '|') WHEN len(features) = 0 THEN '[]' END AS features,
coalesce(array_to_string(list_transform(redirect, lambda r: coalesce(r.id, '')), '|'), '') AS redirect_ids, coalesce(array_to_string(list_transform(redirect, lambda r: coalesce(r.comment, '')), '|'), '') AS redirect_comments FROM schedule_feeds""")
def piped_arrays(spark, sf_dir):
    return schedule(spark, sf_dir).select("feed_row_id", tx.piped(F.col("features")).alias("features"), tx.redirect_ids(F.col("redirect")).alias("redirect_ids"), tx.redirect_comments(F.col("redirect")).alias("redirect_comments"))


@query("SELECT feed_row_id, CAST(len(list_filter(redirect, lambda r: r.id IS NOT NULL AND r.id <> 'None')) AS INTEGER) AS usable FROM schedule_feeds WHERE redirect IS NOT NULL")
def redirect_filter(spark, sf_dir):
    return schedule(spark, sf_dir).filter("redirect IS NOT NULL").select("feed_row_id", F.size(pr.usable_redirects(F.col("redirect"))).alias("usable"))


_ISSUE = "CASE WHEN contains(x, 'new feed') OR contains(x, 'new source') THEN 'New feed' WHEN contains(x, 'source update') OR contains(x, 'feed update') THEN 'Feed update' WHEN contains(x, 'removed') THEN 'removed' ELSE 'unknown' END"
_KIND = "CASE WHEN length(c) < 3 THEN 'gu' WHEN contains(y, 'schedule') THEN 'Schedule' WHEN contains(y, 'realtime') THEN 'Realtime' WHEN contains(y, 'vehiclepositions') THEN 'vp' WHEN contains(y, 'tripupdates') THEN 'tu' WHEN contains(y, 'servicealerts') THEN 'sa' ELSE 'gu' END"


@query(f"""SELECT line_id, {_ISSUE} AS issue, {_KIND} AS kind, coalesce(strftime(coalesce(try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%Y-%m-%d')), '%m/%d/%Y'), '01/01/1970') AS day, coalesce(TRY_CAST(trim(a) AS INTEGER), 0) AS auth
FROM (SELECT line_id, lower(f[6]) AS x, f[5] AS c, regexp_replace(lower(f[5]), '\\s+', '', 'g') AS y, regexp_extract(f[2], '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS d, f[13] AS a
FROM (SELECT line_id, string_split(line, ',') AS f FROM form_lines))""")
def classify(spark, sf_dir):
    rows = table(spark, sf_dir, "form_lines").select("line_id", F.split("line", ",").alias("f"))
    get = lambda i: F.get("f", F.lit(i))
    return rows.select("line_id", tx.issue_type(get(5)).alias("issue"), tx.data_type(get(4)).alias("kind"), tx.found_date(get(1)).alias("day"), tx.whole_number(get(12), 0).alias("auth"))


@query(r"""SELECT rt_row_id, regexp_extract(urls.direct_download, '^(https?://[^/?#]*)', 1) AS referer, replace(urls.latest, 'https://archive.example/', '') AS path,
regexp_replace(regexp_extract(urls.latest, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS base FROM realtime_feeds""")
def url_parts(spark, sf_dir):
    return realtime(spark, sf_dir).select("rt_row_id", tx.referer(F.col("urls.direct_download")).alias("referer"), tx.without_prefix(F.col("urls.latest"), "https://archive.example/").alias("path"), tx.base_name(F.col("urls.latest")).alias("base"))


@query("SELECT line_id, replace(replace(line, '''', 'ʼ'), chr(10), '') AS line, CASE WHEN batch_no % 2 = 0 THEN DATE '2024-06-01' END AS day FROM form_lines")
def typographic_text(spark, sf_dir):
    rows = table(spark, sf_dir, "form_lines")
    flag = F.when(F.col("batch_no") % 2 == 0, F.lit("x")).otherwise(F.lit(""))
    return rows.select("line_id", tx.typographic(F.col("line")).alias("line"), tx.dated_if(flag, F.lit("2024-06-01").cast("date")).alias("day"))


@query("""SELECT src_row, CASE WHEN x <> '' THEN CASE WHEN length(y) >= 3 THEN array_to_string(string_split(y, ' '), '>') ELSE '' END END AS ids FROM (SELECT src_row, redirect.id AS x, replace(redirect.id, '"', '') AS y FROM sources)""")
def redirect_lists(spark, sf_dir):
    entries = tx.redirect_list(F.col("redirect.id"))
    return table(spark, sf_dir, "sources").select("src_row", F.array_join(F.transform(entries, lambda r: r["id"]), ">").alias("ids"))


# Joins through references.
@query(_REFS + " SELECT rt_row_id, position, ref, s.mdb_source_id IS NOT NULL AS found, s.status AS status FROM refs LEFT JOIN s ON refs.ref = s.mdb_source_id")
def ref_lookup(spark, sf_dir):
    return lookup.resolve(realtime(spark, sf_dir), "rt_row_id", "static_reference", latest_schedule(spark, sf_dir), "mdb_source_id", ["status"])


@query(_REFS + " SELECT rt_row_id, ref FROM refs WHERE ref NOT IN (SELECT mdb_source_id FROM s)")
def ref_dangling(spark, sf_dir):
    return lookup.dangling(realtime(spark, sf_dir), "rt_row_id", "static_reference", latest_schedule(spark, sf_dir), "mdb_source_id")


def _any_reference(spark, sf_dir, condition, own=None):
    return lookup.any_reference(realtime(spark, sf_dir), "rt_row_id", "static_reference", latest_schedule(spark, sf_dir), "mdb_source_id", condition, own).select("rt_row_id")


@query(_REFS + " SELECT DISTINCT rt_row_id FROM refs JOIN s ON refs.ref = s.mdb_source_id WHERE s.location.subdivision_name = 'Samerhoba State'")
def ref_semi_subdivision(spark, sf_dir):
    return _any_reference(spark, sf_dir, pr.same(F.col("location.subdivision_name"), "Samerhoba State"))


@query(_REFS + " SELECT DISTINCT rt_row_id FROM refs JOIN s ON refs.ref = s.mdb_source_id WHERE s.location.country_code = 'XB'")
def ref_semi_country(spark, sf_dir):
    return _any_reference(spark, sf_dir, pr.same(F.col("location.country_code"), "XB"))


@query(_REFS + " SELECT rt_row_id FROM refs JOIN s ON refs.ref = s.mdb_source_id WHERE list_contains(s.features, 'pathways') UNION SELECT rt_row_id FROM realtime_feeds WHERE list_contains(features, 'pathways')")
def ref_semi_or_self(spark, sf_dir):
    return _any_reference(spark, sf_dir, pr.has_feature(F.col("features"), "pathways"), pr.has_feature(F.col("features"), "pathways"))


@query(_REFS + f" SELECT DISTINCT rt_row_id FROM refs JOIN (SELECT mdb_source_id, location.bounding_box AS b FROM s) s ON refs.ref = s.mdb_source_id WHERE b.maximum_latitude > {BOX[0]} AND {BOX[1]} > b.minimum_latitude AND b.maximum_longitude > {BOX[2]} AND {BOX[3]} > b.minimum_longitude")
def ref_semi_bbox(spark, sf_dir):
    b = tuple(F.col(f"location.bounding_box.{n}") for n in ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude"))
    return _any_reference(spark, sf_dir, pr.overlapping_boxes(b, BOX))


@query(_LATEST + " SELECT rt_row_id, CASE WHEN coalesce(len(static_reference), 0) = 0 THEN 'unknown' ELSE s.location.country_code END AS country FROM realtime_feeds f LEFT JOIN s ON trim(f.static_reference[1]) = s.mdb_source_id")
def first_ref_enrich(spark, sf_dir):
    side = latest_schedule(spark, sf_dir).select("mdb_source_id", F.col("location.country_code").alias("country"))
    return lookup.first_reference(realtime(spark, sf_dir).select("rt_row_id", "static_reference"), "static_reference", side, "mdb_source_id", "country", F.lit("unknown")).select("rt_row_id", "country")


@query("""WITH folders AS (SELECT mdb_source_id || '-' || feed_row_id AS ignored, 'report-' || mdb_source_id AS folder FROM schedule_feeds WHERE feed_row_id % 3 <> 0),
ids AS (SELECT DISTINCT mdb_source_id FROM schedule_feeds WHERE mdb_source_id IS NOT NULL)
SELECT mdb_source_id, min(folder) AS folder FROM folders JOIN ids ON folder LIKE '%-' || mdb_source_id GROUP BY mdb_source_id HAVING count(*) = 1""")
def report_folders(spark, sf_dir):
    rows = schedule(spark, sf_dir)
    folders = rows.filter("feed_row_id % 3 <> 0").select(F.concat(F.lit("report-"), "mdb_source_id").alias("folder"))
    return lookup.suffix_match(folders, "folder", rows, "mdb_source_id")


# Whole questions over both kinds of feeds.
def sources(spark: SparkSession, sf_dir: str) -> Sources:
    drop = ("feed_row_id", "rt_row_id", "updated_at", "loaded_at")
    return Sources(latest_schedule(spark, sf_dir).drop(*drop), latest_realtime(spark, sf_dir).drop(*drop))


def _both_sql(own: str, live: str) -> str:
    return _LATEST + f""", refs AS (SELECT mdb_source_id, trim(unnest(static_reference)) AS ref FROM r),
h AS (SELECT mdb_source_id, data_type, status FROM s WHERE {own}), l AS (SELECT mdb_source_id, data_type, status FROM r WHERE {live})
SELECT * FROM l UNION ALL SELECT * FROM h WHERE mdb_source_id NOT IN (SELECT mdb_source_id FROM l)"""


def _referring_sql(own: str) -> str:
    return f"mdb_source_id IN (SELECT refs.mdb_source_id FROM refs JOIN s ON refs.ref = s.mdb_source_id WHERE {own})"


_IN_BOX = f"coalesce(s.location.bounding_box.maximum_latitude > {BOX[0]} AND {BOX[1]} > s.location.bounding_box.minimum_latitude AND s.location.bounding_box.maximum_longitude > {BOX[2]} AND {BOX[3]} > s.location.bounding_box.minimum_longitude, false)"


def _shown(df: DataFrame) -> DataFrame:
    return df.select("mdb_source_id", "data_type", "status")


@query(_both_sql("true", "true"))
def sources_all(spark, sf_dir):
    return _shown(sources(spark, sf_dir).all())


@query(_both_sql("s.location.country_code = 'XB'", _referring_sql("s.location.country_code = 'XB'")))
def sources_by_country(spark, sf_dir):
    return _shown(sources(spark, sf_dir).by_country_code("XB"))


@query(_both_sql(_IN_BOX, _referring_sql(_IN_BOX)))
def sources_by_box(spark, sf_dir):
    return _shown(sources(spark, sf_dir).by_bounding_box(*BOX))


@query(_both_sql("list_contains(features, 'pathways')", _referring_sql("list_contains(s.features, 'pathways')") + " OR list_contains(features, 'pathways')"))
def sources_by_feature(spark, sf_dir):
    return _shown(sources(spark, sf_dir).by_feature("pathways"))


@query(_both_sql("status = 'active' OR status IS NULL", "status = 'active' OR status IS NULL"))
def sources_by_status(spark, sf_dir):
    return _shown(sources(spark, sf_dir).by_status("active"))


@query(_both_sql("is_official = 'True'", "is_official = 'True'"))
def sources_by_official(spark, sf_dir):
    return _shown(sources(spark, sf_dir).by_is_official("True"))


# Aggregates, quantifiers, rules.
@query("""SELECT mdb_source_id, CASE WHEN k THEN a END AS minimum_latitude, CASE WHEN k THEN b END AS maximum_latitude, CASE WHEN k THEN c END AS minimum_longitude, CASE WHEN k THEN d END AS maximum_longitude
FROM (SELECT mdb_source_id, min(minimum_latitude) AS a, max(minimum_latitude) AS b, min(maximum_longitude) AS c, max(maximum_longitude) AS d, count(minimum_latitude) > 0 AND count(maximum_longitude) > 0 AS k FROM box_log GROUP BY mdb_source_id)""")
def bbox_extract(spark, sf_dir):
    return quality.bounding_boxes(table(spark, sf_dir, "box_log"), ["mdb_source_id"], F.col("minimum_latitude"), F.col("maximum_longitude"))


@query("SELECT min(minimum_latitude) AS minimum_latitude, max(minimum_latitude) AS maximum_latitude, min(minimum_longitude) AS minimum_longitude, max(minimum_longitude) AS maximum_longitude FROM box_log")
def bbox_global(spark, sf_dir):
    return quality.bounding_boxes(table(spark, sf_dir, "box_log"), [], F.col("minimum_latitude"), F.col("minimum_longitude"))


@query("""WITH st AS (SELECT o_orderkey AS trip_id, o_custkey AS shape_id, max(l_extendedprice) AS a FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
sh AS (SELECT o_custkey AS shape_id, max(o_totalprice * 0.25) AS b FROM orders GROUP BY ALL)
SELECT trip_id, st.shape_id, a AS max_stop_times, b AS max_shapes, round((a - b) / b, 6) AS relative_diff FROM st JOIN sh USING (shape_id) WHERE a > b""")
def shape_exceeded(spark, sf_dir):
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")  # noqa: E741
    trips = o.select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("shape_id"))
    stops = l.select(F.col("l_orderkey").alias("trip_id"), F.col("l_extendedprice").alias("shape_dist_traveled"))
    limits = o.select(F.col("o_custkey").alias("shape_id"), (F.col("o_totalprice") * 0.25).alias("shape_dist_traveled"))
    return quality.exceeded_distance(trips, stops, limits).withColumn("relative_diff", F.round("relative_diff", 6))


@query("SELECT p_brand, bool_and(p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)) AS all_in FROM part GROUP BY p_brand")
def all_in(spark, sf_dir):
    part, l = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")  # noqa: E741
    used = l.filter("l_quantity > 45").select(F.col("l_partkey").alias("k")).distinct()
    brands = part.select("p_brand").distinct().withColumnRenamed("p_brand", "p_brand")
    return quality.all_within(part, "p_partkey", used.join(part, F.col("k") == F.col("p_partkey")).select("p_brand", "k"), "k", "p_brand").join(brands, "p_brand")


@query("SELECT event_type, bool_and(nullif(value, 0) IS NOT NULL) AS every, bool_and(nullif(event_type, 'view') IS NULL) AS none, count(nullif(event_type, 'view')) > 0 OR count(nullif(event_type, 'click')) > 0 AS some FROM events GROUP BY event_type")
def quantifiers(spark, sf_dir):
    a, b = F.nullif("event_type", F.lit("view")), F.nullif("event_type", F.lit("click"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(pr.all_defined(F.nullif("value", F.lit(0.0))).alias("every"), pr.all_undefined(a).alias("none"), pr.any_defined(a, b).alias("some"))


@query("SELECT user_id, count(*) + 1 >= 70 AS enough, count(*) + 1 >= 4 AS four FROM events GROUP BY user_id")
def row_threshold(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(pr.at_least_lines(70).alias("enough"), pr.at_least_lines(4).alias("four"))


@query("""SELECT l_partkey, coalesce(bool_or(d > TIMESTAMP '2001-11-04' - INTERVAL 182 DAY), false) AS recent FROM (SELECT l_partkey, try_strptime(CASE WHEN l_orderkey % 7 = 0 THEN 'x' ELSE strftime(l_shipdate, '%Y%m%d') END, '%Y%m%d') AS d FROM lineitem) GROUP BY l_partkey""")
def recency(spark, sf_dir):
    shown = F.when(F.col("l_orderkey") % 7 == 0, F.lit("x")).otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(tx.recent(shown, F.lit("2001-11-04").cast("timestamp")).alias("recent"))


@query("""SELECT o_custkey, CASE WHEN NOT recent THEN 'inactive' END AS status, nullif(concat_ws(',', CASE WHEN n > 12 THEN 'many' END, CASE WHEN top > 400000 THEN 'large' END, CASE WHEN open > 6 THEN 'open' END), '') AS tags
FROM (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top, count(*) FILTER (o_orderstatus = 'O') AS open, bool_or(o_orderdate > TIMESTAMP '2001-01-01') AS recent FROM orders GROUP BY o_custkey)""")
def feature_tags(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.bool_or(F.col("o_orderdate") > F.lit("2001-01-01").cast("timestamp")).alias("recent"))
    tags = quality.feature_tags({"many": F.col("n") > 12, "large": F.col("top") > 400000, "open": F.col("open") > 6})
    return o.select("o_custkey", quality.derived_status(F.col("recent")).alias("status"), F.array_join(tags, ",").alias("tags"))


def _facts(spark, sf_dir):
    """A dataset's facts, made from its row: a report whose notices depend on the row's number, and simple tests."""
    k = F.col("feed_row_id") % 12
    sample = lambda file, name: F.array(F.struct(F.lit(file).alias("filename"), F.lit(name).alias("fieldName")))
    notice = lambda code, file, name: F.struct(F.lit(code).alias("code"), sample(file, name).alias("sampleNotices"))
    notices = (
        F.when(k == 0, F.lit(None))
        .when(k == 1, F.array(notice("missing_recommended_field", "routes.txt", "agency_id")))
        .when(k == 2, F.array(notice("missing_recommended_field", "feed_info.txt", "feed_version"), notice("missing_recommended_file", "feed_info.txt", "x")))
        .when(k == 3, F.array(notice("missing_timepoint_column", "stop_times.txt", "x")))
        .otherwise(F.array().cast("array<struct<code:string,sampleNotices:array<struct<filename:string,fieldName:string>>>>"))
    )
    facts = {"all_short_names": F.col("provider").isNotNull(), "no_long_names": F.col("name").isNull(), "no_contact_url": F.col("urls.license").isNull(), "all_contact_emails": F.col("feed_contact_email").isNotNull(), "no_contact_email": F.col("feed_contact_email").isNull(), "all_contact_urls": F.col("urls.license").isNotNull(), "blocks_in_frequencies": F.col("status") == "active"}
    return schedule(spark, sf_dir).select("feed_row_id", notices.alias("notices"), *[c.alias(n) for n, c in facts.items()]), {n: F.col(n) for n in facts}


_RULES = """WITH f AS (SELECT feed_row_id, feed_row_id % 12 AS k, provider IS NOT NULL AS a, name IS NULL AS b, urls.license IS NULL AS c, feed_contact_email IS NOT NULL AS d, coalesce(status = 'active', false) AS e FROM schedule_feeds),
v AS (SELECT feed_row_id, a AND b AS rule_1, k <> 0 AND k <> 1 AND true AS rule_2, k <> 0 AS rule_3, k <> 0 AS rule_4, k <> 0 AND k <> 2 AS rule_5, k <> 0 AS rule_6, k <> 0 AS rule_7, k <> 0 AND k <> 2 AS rule_8, c AND d AS rule_9, NOT d AND NOT c AS rule_10, k <> 0 AND k <> 3 AS rule_11, e AS rule_12 FROM f)"""


@query(_RULES + " SELECT * FROM v")
def best_practice_rules(spark, sf_dir):
    df, facts = _facts(spark, sf_dir)
    return quality.verdicts(df, "feed_row_id", quality.best_practices(F.col("notices"), facts))


@query(_RULES + ", l AS (UNPIVOT (SELECT feed_row_id, rule_1, rule_9, rule_10, rule_12 FROM v) ON rule_1, rule_9, rule_10, rule_12 INTO NAME rule VALUE passed), n AS (SELECT rule, feed_row_id, CAST(row_number() OVER (PARTITION BY rule ORDER BY feed_row_id) AS INTEGER) AS n FROM l WHERE passed) SELECT n, max(CASE WHEN rule = 'rule_1' THEN feed_row_id END) AS rule_1, max(CASE WHEN rule = 'rule_9' THEN feed_row_id END) AS rule_9, max(CASE WHEN rule = 'rule_10' THEN feed_row_id END) AS rule_10, max(CASE WHEN rule = 'rule_12' THEN feed_row_id END) AS rule_12 FROM n GROUP BY n")
def rule_results(spark, sf_dir):
    names = ["rule_1", "rule_9", "rule_10", "rule_12"]
    long = quality.verdicts_long(best_practice_rules(spark, sf_dir), "feed_row_id", 12).filter(F.col("passed") & F.col("rule").isin(names))
    return quality.packed_columns(long, "feed_row_id", "rule", names)


@query(_RULES + " SELECT count(*) FILTER (rule_1) AS rule_1, count(*) FILTER (rule_5) AS rule_5, count(*) FILTER (rule_12) AS rule_12 FROM v")
def rule_counts(spark, sf_dir):
    wide = best_practice_rules(spark, sf_dir)
    return quality.filled_counts(wide.select(*[F.when(F.col(r), 1).alias(r) for r in ("rule_1", "rule_5", "rule_12")]), ["rule_1", "rule_5", "rule_12"])


@query("SELECT mdb_source_id, count(*) AS n FROM schedule_feeds WHERE mdb_source_id IS NOT NULL GROUP BY mdb_source_id HAVING count(*) > 1")
def uniqueness(spark, sf_dir):
    return quality.repeated(schedule(spark, sf_dir), "mdb_source_id")


@query("SELECT min(feed_row_id) = 1 AND max(feed_row_id) = count(*) AND count(DISTINCT feed_row_id) = count(*) AS contiguous FROM schedule_feeds")
def contiguity(spark, sf_dir):
    return quality.contiguous(schedule(spark, sf_dir), "feed_row_id")


@query("SELECT (SELECT count(*) FROM schedule_feeds) + (SELECT count(*) FROM realtime_feeds) + 1 AS next_id")
def next_id_by_count(spark, sf_dir):
    return merge.next_id(schedule(spark, sf_dir), realtime(spark, sf_dir))


@query("SELECT max(TRY_CAST(mdb_source_id AS BIGINT)) + 1 AS next_id FROM (SELECT mdb_source_id FROM schedule_feeds UNION ALL SELECT mdb_source_id FROM realtime_feeds)")
def next_id_by_maximum(spark, sf_dir):
    return merge.next_id(schedule(spark, sf_dir), realtime(spark, sf_dir), key="mdb_source_id")


@query("SELECT count(provider) AS provider, count(name) AS name, count(status) AS status, count(features) AS features FROM schedule_feeds")
def filled_counts(spark, sf_dir):
    return quality.filled_counts(schedule(spark, sf_dir), ["provider", "name", "status", "features"])


# Order.
@query("SELECT event_id, last_value(nullif(event_type, 'view') IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events")
def forward_fill(spark, sf_dir):
    return ordered.forward_fill(table(spark, sf_dir, "events"), ["event_id"], F.nullif("event_type", F.lit("view")), "filled").select("event_id", "filled")


@query("SELECT event_id, last_value(nullif(event_type, 'view') IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events")
def forward_fill_by_user(spark, sf_dir):
    return ordered.forward_fill(table(spark, sf_dir, "events"), ["event_id"], F.nullif("event_type", F.lit("view")), "filled", ["user_id"]).select("event_id", "filled")


@query("SELECT p_partkey, CAST(ntile(64) OVER (ORDER BY p_partkey) AS INTEGER) AS chunk FROM part")
def balanced_chunks(spark, sf_dir):
    return ordered.chunks(table(spark, sf_dir, "part"), ["p_partkey"]).select("p_partkey", "chunk")


@query("SELECT feed_row_id, row_number() OVER (ORDER BY TRY_CAST(mdb_source_id AS BIGINT) NULLS LAST, mdb_source_id, feed_row_id) AS row_no FROM schedule_feeds")
def ordered_ids(spark, sf_dir):
    rows = schedule(spark, sf_dir).select("feed_row_id", "mdb_source_id", F.coalesce(F.col("mdb_source_id").try_cast("bigint"), F.lit(1 << 62)).alias("number"))
    return ordered.row_numbers(rows, ["number", "mdb_source_id", "feed_row_id"]).select("feed_row_id", "row_no")


_READY = """WITH u AS (SELECT feed_row_id, 'feed-' || feed_row_id || '-' || coalesce(provider, '') AS base, urls.direct_download AS direct, urls.latest AS latest, urls.api_key_parameter_name AS key, urls.authentication_type AS auth FROM schedule_feeds WHERE status IS NULL OR status <> 'deprecated')"""
_ASCII = "('\"' || array_to_string(list_transform(regexp_extract_all({0}, '(?s).'), lambda c: CASE WHEN c IN ('\"', chr(92)) THEN chr(92) || c WHEN unicode(c) BETWEEN 32 AND 126 THEN c WHEN c = chr(10) THEN chr(92) || 'n' WHEN c = chr(9) THEN chr(92) || 't' WHEN c = chr(13) THEN chr(92) || 'r' WHEN unicode(c) < 65536 THEN chr(92) || format('u{{:04x}}', unicode(c)) ELSE chr(92) || format('u{{:04x}}', 55296 + (unicode(c) - 65536) // 1024) || chr(92) || format('u{{:04x}}', 56320 + (unicode(c) - 65536) % 1024) END), '') || '\"')"
_JOBS = _READY + f""", r AS (SELECT *, ntile(64) OVER (ORDER BY feed_row_id) AS chunk FROM u WHERE direct IS NOT NULL AND latest IS NOT NULL),
t AS (SELECT chunk, feed_row_id, '{{"base":' || {_ASCII.format("base")} || ',"direct_download":' || {_ASCII.format("direct")} || ',"latest":' || {_ASCII.format("replace(latest, 'https://archive.example/', '')")} || CASE WHEN coalesce(auth, 0) <> 0 OR coalesce(key, '') <> '' THEN ',"api_key_parameter_name":' || coalesce({_ASCII.format("key")}, 'null') ELSE '' END || '}}' AS x FROM r),
j AS (SELECT chunk, string_agg(x, '' ORDER BY feed_row_id DESC) AS s FROM t GROUP BY chunk),
d AS (SELECT CAST(chunk AS INTEGER) AS chunk, sha1(s) AS hash, replace(s, '}}{{', '}} {{') AS data FROM j)
"""


def _url_rows(spark, sf_dir):
    base = F.concat(F.lit("feed-"), "feed_row_id", F.lit("-"), F.coalesce("provider", F.lit("")))
    return schedule(spark, sf_dir).select("feed_row_id", "status", base.alias("base"), F.col("urls.direct_download").alias("direct"), F.col("urls.latest").alias("latest"), F.col("urls.api_key_parameter_name").alias("key"), F.col("urls.authentication_type").alias("auth"))


@query(_JOBS + " SELECT * FROM d")
def url_matrix(spark, sf_dir):
    ready, _ = matrix.split_ready(_url_rows(spark, sf_dir), F.col("direct"), F.col("latest"), F.col("status"))
    fields = {"base": F.col("base"), "direct_download": F.col("direct"), "latest": matrix.latest_path(F.col("latest"), "https://archive.example/"), "api_key_parameter_name": F.col("key")}
    return matrix.jobs(ready, ["feed_row_id"], matrix.compact_json(fields, {"api_key_parameter_name": matrix.key_present(F.col("auth"), F.col("key"))}))


@query(_JOBS + """ SELECT '{"include":[' || string_agg('{"hash":"' || hash || '","data":' || to_json(data) || '}', ',' ORDER BY chunk) || ']}' AS matrix FROM d""")
def url_matrix_json(spark, sf_dir):
    return matrix.matrix_json(url_matrix(spark, sf_dir))


@query(_READY + """ SELECT feed_row_id, CASE WHEN direct IS NULL OR latest IS NULL THEN base || ': FAILURE! Direct download URL is ' || coalesce(direct, 'None') || ' and latest URL is ' || coalesce(latest, 'None') || '. Both URLS must be defined to update the source latest URL.' ELSE base || ': SUCCESS! Both direct download and latest URLs were fetched.' END AS line FROM u""")
def url_log(spark, sf_dir):
    _, looked = matrix.split_ready(_url_rows(spark, sf_dir), F.col("direct"), F.col("latest"), F.col("status"))
    return looked.select("feed_row_id", matrix.log_line(F.col("base"), F.col("direct"), F.col("latest")).alias("line"))


# Sets and patches.
@query("""SELECT id, coalesce(max(CASE WHEN part = 1 THEN name END), max(CASE WHEN part = 0 THEN name END)) AS name, coalesce(max(CASE WHEN part = 1 THEN bal END), max(CASE WHEN part = 0 THEN bal END)) AS bal
FROM (SELECT 0 AS part, c_custkey AS id, c_name AS name, c_acctbal AS bal FROM customer UNION ALL SELECT 1, s_suppkey, s_name, s_acctbal FROM supplier) GROUP BY id""")
def union_override(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return merge.override_union([c, s], "id")


@query("SELECT mdb_source_id, status, NULL::VARCHAR AS note FROM schedule_feeds UNION ALL SELECT mdb_source_id, status, note FROM realtime_feeds")
def concat_rows(spark, sf_dir):
    return merge.concat([schedule(spark, sf_dir).select("mdb_source_id", "status"), realtime(spark, sf_dir).select("mdb_source_id", "status", "note")])


@query("SELECT DISTINCT status FROM (SELECT status FROM schedule_feeds UNION ALL SELECT status FROM realtime_feeds)")
def distinct_values(spark, sf_dir):
    return merge.concat([schedule(spark, sf_dir).select("status"), realtime(spark, sf_dir).select("status")]).distinct()


@query(_LATEST + """, p AS (SELECT mdb_source_id, max(nullif(trim(x.provider), '')) AS provider, max(x.status) AS status FROM sources x WHERE mdb_source_id IS NOT NULL GROUP BY mdb_source_id)
SELECT s.mdb_source_id, coalesce(p.provider, s.provider) AS provider, coalesce(p.status, s.status) AS status, s.data_type, s.name FROM s LEFT JOIN p USING (mdb_source_id)""")
def patch_merge(spark, sf_dir):
    base = latest_schedule(spark, sf_dir).select("mdb_source_id", "provider", "status", "data_type", "name")
    patch = table(spark, sf_dir, "sources").filter("mdb_source_id IS NOT NULL").groupBy("mdb_source_id").agg(F.max(F.nullif(F.trim("provider"), F.lit(""))).alias("provider"), F.max("status").alias("status"), F.max("data_type").alias("data_type"))
    return merge.patch_merge(base, patch, "mdb_source_id")


@query(_LATEST + " SELECT mdb_source_id, provider FROM s UNION ALL SELECT mdb_source_id, provider FROM r WHERE mdb_source_id NOT IN (SELECT mdb_source_id FROM s)")
def append_entities(spark, sf_dir):
    return merge.append_entities(latest_schedule(spark, sf_dir), latest_realtime(spark, sf_dir).select("mdb_source_id", "provider")).select("mdb_source_id", "provider")


# Export and form.
def _catalog(spark, sf_dir):
    s = latest_schedule(spark, sf_dir).drop("feed_row_id", "updated_at", "loaded_at")
    r = latest_realtime(spark, sf_dir).drop("rt_row_id", "loaded_at")
    return s, merge.override_union([s, r], "mdb_source_id")


_EDGE = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


@query(_LATEST + f""", k AS (SELECT mdb_source_id, data_type, provider, name, status, features, redirect, static_reference, entity_type, location, urls FROM (SELECT *, NULL::VARCHAR[] AS static_reference, NULL::VARCHAR[] AS entity_type FROM s) WHERE mdb_source_id NOT IN (SELECT mdb_source_id FROM r)
UNION ALL SELECT r.mdb_source_id, r.data_type, r.provider, r.name, r.status, r.features, r.redirect, r.static_reference, r.entity_type, CASE WHEN coalesce(len(r.static_reference), 0) = 0 THEN {{'country_code': 'unknown', 'subdivision_name': 'unknown', 'municipality': 'unknown', 'bounding_box': NULL}} ELSE s.location END, r.urls FROM r LEFT JOIN s ON trim(r.static_reference[1]) = s.mdb_source_id)
SELECT mdb_source_id, {_EDGE.format('provider')} AS provider, location.country_code AS country, location.bounding_box.minimum_latitude AS min_lat, CASE WHEN len(static_reference) > 0 THEN array_to_string(static_reference, '|') WHEN len(static_reference) = 0 THEN '[]' END AS refs, CASE WHEN len(features) > 0 THEN array_to_string(features, '|') WHEN len(features) = 0 THEN '[]' END AS features, coalesce(array_to_string(list_transform(redirect, lambda x: coalesce(x.id, '')), '|'), '') AS redirect_ids, urls.authentication_type AS auth FROM k""")
def export_flatten(spark, sf_dir):
    s, both = _catalog(spark, sf_dir)
    rows = export.export_rows(both, s)
    names = {"mdb_source_id": "mdb_source_id", "provider": "provider", "location.country_code": "country", "location.bounding_box.minimum_latitude": "min_lat", "static_reference": "refs", "features": "features", "redirect.id": "redirect_ids", "urls.authentication_type": "auth"}
    return rows.select(*[shapes.quoted(a).alias(b) for a, b in names.items()])


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STRIP = "trim({0}, " + _BLANKS + ")"
_PIPED = "CASE WHEN len({0}) > 0 THEN array_to_string({0}, '|') WHEN len({0}) = 0 THEN '[]' END"
_PLACED = "CASE WHEN r.mdb_source_id IS NULL THEN s.location WHEN coalesce(len(r.static_reference), 0) = 0 THEN {'country_code': 'unknown', 'subdivision_name': 'unknown', 'municipality': 'unknown', 'bounding_box': NULL} ELSE f.location END"


def _export_sql() -> str:
    own = lambda c: f"CASE WHEN r.mdb_source_id IS NULL THEN s.{c} ELSE r.{c} END"
    live = lambda c: f"r.{c}"
    texts = {c: _STRIP.format(own(c)) for c in ("data_type", "provider", "is_official", "is_producer_url_unstable", "name", "feed_contact_email", "status")}
    columns = {"mdb_source_id": _STRIP.format("coalesce(r.mdb_source_id, s.mdb_source_id)"), **texts, "note": _STRIP.format(live("note"))}
    columns |= {"entity_type": _STRIP.format(_PIPED.format(live("entity_type"))), "static_reference": _STRIP.format(_PIPED.format(live("static_reference"))), "features": _STRIP.format(_PIPED.format(f"({own('features')})"))}
    columns |= {f"urls.{c}": f"({own('urls')}).{c}" for c in ("direct_download", "authentication_type", "authentication_info", "api_key_parameter_name", "latest", "license")}
    columns |= {f"location.{c}": f"({_PLACED}).{c}" for c in ("country_code", "subdivision_name", "municipality")}
    columns |= {f"location.bounding_box.{c}": f"({_PLACED}).bounding_box.{c}" for c in ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude", "extracted_on")}
    columns |= {f"redirect.{c}": f"coalesce(array_to_string(list_transform({own('redirect')}, lambda x: coalesce(x.{c}, '')), '|'), '')" for c in ("id", "comment")}
    return _LATEST + "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in columns.items()) + " FROM s FULL JOIN r ON s.mdb_source_id = r.mdb_source_id LEFT JOIN s f ON trim(r.static_reference[1]) = f.mdb_source_id"


@query(_export_sql())
def export_all(spark, sf_dir):
    s, both = _catalog(spark, sf_dir)
    return export.export_rows(both, s)


def _form(spark, sf_dir):
    return load_form(ordered.ranged(table(spark, sf_dir, "form_lines").select("line_id", "line"), ["line_id"]))[0]


def _form_sql() -> str:
    """Common tables up to ``p``, the prepared rows."""
    cell = lambda n: f"fields[{FORM_FIELDS.index(n) + 1}]"
    strip = lambda n: _STRIP.format(cell(n))
    address = lambda n: f"CASE WHEN {strip(n)} <> '' AND NOT regexp_matches({strip(n)}, '{pr.WEB_ADDRESS}') THEN '\"\"' ELSE {strip(n)} END"
    number = lambda x: f"coalesce(TRY_CAST(trim({x}) AS INTEGER), 0)"
    holds = lambda text, words: " OR ".join(f"contains({text}, '{w}')" for w in words)
    chosen = lambda text, options, other: "CASE " + " ".join(f"WHEN {holds(text, ws)} THEN '{v}'" for v, ws in options) + f" ELSE '{other}' END"
    day = f"regexp_extract({strip('timestamp')}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
    ids = f"replace({cell('redirects')}, '\"', '')"
    kinds = [(code, (w,)) for w, code in tx.DATA_TYPE_WORDS]
    columns = {
        "known": f"last_value(nullif({strip('provider')}, '') IGNORE NULLS) OVER (ORDER BY line_id ROWS UNBOUNDED PRECEDING)",
        "typed": strip("provider"),
        "issue": chosen(f"lower({strip('issue_type')})", tx.ISSUE_WORDS, "unknown"),
        "kind": chosen(rf"regexp_replace(lower({cell('datatype')}), '\s+', '', 'g')", kinds, tx.UNKNOWN_TYPE),
        "day": f"coalesce(strftime(coalesce(try_strptime({day}, '%m/%d/%Y'), try_strptime({day}, '%Y-%m-%d')), '%m/%d/%Y'), '01/01/1970')",
        "direct_download_url": address("downloadurl"),
        "license_url": address("license_url"),
        "mdb_source_id": number(f"trim({cell('old_id')}, '\"')"),
        "authentication_type": number(strip("auth_type")),
        "authentication_info_url": strip("auth_info_url"),
        "api_key_parameter_name": strip("api_key_name"),
        "country_code": strip("country"),
        "subdivision_name": strip("subdivision"),
        "feed_contact_email": strip("email"),
        "ids": f"CASE WHEN {cell('redirects')} = '' THEN NULL WHEN length({ids}) < 3 THEN [] ELSE string_split({ids}, ' ') END",
        **{n: strip(n) for n in ("municipality", "name", "note", "status")},
    }
    raw = f"{PARSED_FORM}, q AS (SELECT line_id, {', '.join(f'{v} AS {k}' for k, v in columns.items())} FROM judged WHERE reason IS NULL)"
    asked = commands.TO_BE_PROVIDED
    return raw + f", p AS (SELECT * EXCLUDE (known, typed), CASE WHEN typed = '' THEN '{asked} (' || coalesce(known, '{asked}') || ' ?)' ELSE typed END AS provider FROM q)"


def _commands_sql() -> str:
    named = f"CASE WHEN issue = 'removed' THEN '{commands.REMOVAL_NAME}' ELSE name END"

    def shown(argument: str) -> str:
        name = argument.rstrip("*")
        value = {"entity_type": "'[\"' || kind || '\"]'", "name": named}.get(name, f"CAST({name} AS VARCHAR)")
        text = f"'{name}=' || {value}" if argument.endswith("*") else f"'{name}=\"' || {value} || '\"'"
        return f"CASE WHEN {value} NOT IN ('', '\"\"') THEN {text} END" if name in commands.OPTIONAL else text

    redirects = "'redirects=[' || array_to_string(list_transform(ids, lambda x: '{\"id\": \"' || x || '\", \"comment\": \" \"}'), ', ') || ']'"

    def call(verb: str, kind: str) -> str:
        arguments = [*map(shown, commands.CALLS[verb, kind]), *([redirects] if kind == "schedule" else [])]
        return f"'{verb}_gtfs_{kind}_source(' || concat_ws(', ', {', '.join(arguments)}) || ')'"

    either = lambda kind: f"CASE WHEN issue IN ('Feed update', 'removed') THEN {call('update', kind)} ELSE {call('add', kind)} END"
    return _form_sql() + f" SELECT line_id, replace(replace(CASE WHEN kind = 'Schedule' THEN {either('schedule')} ELSE {either('realtime')} END, chr(39), 'ʼ'), chr(10), '') AS command FROM p WHERE kind <> '{tx.UNKNOWN_TYPE}'"


@query(_commands_sql())
def form_commands(spark, sf_dir):
    return commands.call_text(commands.prepared(_form(spark, sf_dir), "line_id"), "line_id")


@query(_form_sql() + " SELECT * EXCLUDE (ids) FROM p")
def form_prepared(spark, sf_dir):
    return commands.prepared(_form(spark, sf_dir), "line_id").drop("redirect")


@query("SELECT line_id, array_to_string(string_split(line, ',')[1:19], '|') AS cells FROM form_lines WHERE len(string_split(line, ',')) >= 19")
def naive_split(spark, sf_dir):
    """The cells of the lines that are wide enough; the others are an error to the naive reader."""
    wide = table(spark, sf_dir, "form_lines").filter(F.size(F.split("line", ",")) >= len(FORM_FIELDS))
    return wide.select("line_id", F.array_join(F.slice(naive_cells(F.col("line"), len(FORM_FIELDS)), 1, len(FORM_FIELDS)), "|").alias("cells"))


@query("SELECT line_id, line FROM form_lines WHERE line_id BETWEEN 3 AND 10")
def rows_in_range(spark, sf_dir):
    return row_range(table(spark, sf_dir, "form_lines"), "3:10", "line_id").select("line_id", "line")


@query(f"{PARSED_FORM} SELECT line_id, sound, CASE WHEN sound THEN len(fields) END AS n_fields, CASE WHEN sound THEN array_to_string(fields, '|') END AS cells FROM judged")
def parsed_widths(spark, sf_dir):
    """Of each line whether it is well-formed and, if so, its fields."""
    parsed = parse_lines(table(spark, sf_dir, "form_lines").select("line_id", "line"))
    return parsed.select("line_id", "sound", F.when(F.col("sound"), F.size("fields")).alias("n_fields"), F.when(F.col("sound"), F.array_join("fields", "|")).alias("cells"))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
