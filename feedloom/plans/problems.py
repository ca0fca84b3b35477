"""Queries of the core data-processing problems (p1, p3 to p6) over their whole tables, and the SQL for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy, nested, packed, regions, spatial
from ..session import table
from ..sources import form

#: The flat columns of each kind of node and their types.
NODE_COLUMNS = {
    "location": {"country_code": "string", "subdivision_name": "string", "municipality": "string"},
    "bounding_box": {"minimum_latitude": "double", "maximum_latitude": "double", "minimum_longitude": "double", "maximum_longitude": "double", "extracted_on": "string"},
    "urls": {"direct_download": "string", "authentication_type": "int", "authentication_info": "string", "api_key_parameter_name": "string", "latest": "string", "license": "string"},
    "redirect": {"id": "string", "comment": "string"},
}
NEAR_KM = 0.1


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten_records(table(spark, sf_dir, "catalog_json"), "record_id", "payload")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(spark, sf_dir).select("record_id", "parent_path", "node_path")


def _p1_flat(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return nested.flat_table(nodes(spark, sf_dir), "record_id", kind, NODE_COLUMNS[kind])

    return query


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = [F.col(c) for c in ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude")]
    lat, lon = spatial.box_centre(*corners)
    boxes = table(spark, sf_dir, "box_log").filter(spatial.usable_box(*corners))
    return spatial.near_pairs(boxes, "box_id", lat, lon, F.col("mdb_source_id"), NEAR_KM).select(F.col("a").alias("box_a"), F.col("b").alias("box_b"))


def p3_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest feed box, by each feed's latest row, that contains the centre of each box."""
    names = ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude")
    corners = [F.col(c) for c in names]
    lat, lon = spatial.box_centre(*corners)
    feeds = table(spark, sf_dir, "schedule_feeds").filter(F.col("mdb_source_id").isNotNull())
    latest = feeds.groupBy("mdb_source_id").agg(F.max(F.struct("loaded_at", "feed_row_id", F.struct(*[F.col(f"location.bounding_box.{c}") for c in names]).alias("box"))).alias("row"))
    areas = latest.select("row.feed_row_id", "row.box.*").filter(spatial.usable_box(*corners))
    boxes = table(spark, sf_dir, "box_log").filter(spatial.usable_box(*corners))
    return regions.containing(boxes, "box_id", lat, lon, regions.boxes_of(areas, "feed_row_id", *corners)).withColumnRenamed("region", "feed_row_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"features": F.col("features"), "entity_type": F.col("entity_type"), "static_reference": F.col("static_reference"), "redirect.id": F.col("redirect.id")}
    return packed.unpack(table(spark, sf_dir, "sources"), "src_row", fields)


def feed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, parent) of each feed with a usable redirect in its latest row; of rows of the same time the largest
    feed_row_id counts."""
    feeds = table(spark, sf_dir, "schedule_feeds").filter(F.col("mdb_source_id").isNotNull())
    usable = F.filter(F.transform("redirect", lambda r: form.trimmed(r["id"])), lambda i: i.isNotNull() & ~i.isin("", "None"))
    rows = feeds.select("mdb_source_id", F.struct("loaded_at", "feed_row_id", F.get(usable, F.lit(0)).alias("parent")).alias("row"))
    latest = rows.groupBy("mdb_source_id").agg(F.max("row").alias("row"))
    return hierarchy.links(latest.select("mdb_source_id", F.col("row.parent").alias("parent")), "mdb_source_id", "parent")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hierarchy.roots(feed_links(spark, sf_dir))
    return found.select(F.col("id").alias("mdb_source_id"), F.coalesce("root", F.lit("")).alias("root_id"), "depth")


def p5_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hierarchy.paths(feed_links(spark, sf_dir))
    return found.select(F.col("id").alias("mdb_source_id"), F.array_join("path", ">").alias("path"), F.element_at("path", -1).alias("root_id"), (F.size("path") - 1).alias("depth"))


def p5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.descendants(hierarchy.paths(feed_links(spark, sf_dir)))


def p5_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes on loops themselves, without those on ways into them."""
    edges = feed_links(spark, sf_dir)
    return hierarchy.loop_members(edges, hierarchy.roots(edges)).select(F.col("id").alias("mdb_source_id"), "loop_id", "loop_size")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return form.load_form(table(spark, sf_dir, "form_lines").select("line_id", "line"))[1].select("line_id", "reason")


def p6_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows with their fields, the typed ones null where the text doesn't cast."""
    good = form.load_form(table(spark, sf_dir, "form_lines").select("line_id", "line"))[0]
    day = F.coalesce(F.try_to_date("timestamp", "yyyy-MM-dd"), F.try_to_date("timestamp", "MM/dd/yyyy"))
    return good.select("line_id", day.alias("day"), *[c for c in form.FORM_FIELDS if c not in ("clientError", "timestamp", "auth_type")], F.col("auth_type").try_cast("int").alias("auth_type"))


def queries() -> dict:
    return {
        "p1_found": p1_found,
        **{f"p1_{kind}": _p1_flat(kind) for kind in NODE_COLUMNS},
        "p3_found": p3_found,
        "p3_regions": p3_regions,
        "p4_found": p4_found,
        "p5_found": p5_found,
        "p5_paths": p5_paths,
        "p5_descendants": p5_descendants,
        "p5_loops": p5_loops,
        "p6_found": p6_found,
        "p6_good": p6_good,
    }


# The values below a record, held as JSON text or not; idx -1 stands for a member's own value.
_NODES = r"""
WITH RECURSIVE v(record_id, kind, parent, idx, val) AS (
  SELECT record_id, k, '', -1, json_extract(payload, '$.' || k)
  FROM catalog_json, (VALUES ('location'), ('urls'), ('redirect')) AS top(k)
  WHERE json_extract(payload, '$.' || k) IS NOT NULL
  UNION ALL
  SELECT record_id, u.kind, u.parent, u.idx, u.val FROM (
    SELECT record_id, unnest(CASE
      WHEN json_type(val) = 'VARCHAR' AND regexp_matches(val->>'$', '^\s*[\{\[]') THEN
        [{'kind': kind, 'parent': parent, 'idx': idx, 'val': (val->>'$')::JSON}]
      WHEN json_type(val) = 'ARRAY' AND idx < 0 THEN
        list_transform(range(json_array_length(val)::BIGINT), lambda i: {'kind': kind, 'parent': parent, 'idx': i::INTEGER, 'val': json_extract(val, '$[' || i || ']')})
      WHEN json_type(val) = 'OBJECT' THEN
        list_transform(list_filter(CASE kind WHEN 'location' THEN ['bounding_box'] WHEN 'redirect' THEN ['urls', 'redirect'] ELSE []::VARCHAR[] END, lambda k: json_extract(val, '$.' || k) IS NOT NULL),
          lambda k: {'kind': k, 'parent': parent || CASE WHEN parent = '' THEN '' ELSE '.' END || kind || '[' || greatest(idx, 0) || ']', 'idx': -1, 'val': json_extract(val, '$.' || k)})
      ELSE [] END) AS u FROM v)
),
nodes AS (
  SELECT record_id, kind, parent AS parent_path, parent || CASE WHEN parent = '' THEN '' ELSE '.' END || kind || '[' || greatest(idx, 0) || ']' AS node_path, val
  FROM v
  WHERE (json_type(val) = 'OBJECT' AND len(list_filter(json_keys(val), lambda k: json_type(json_extract(val, '$."' || k || '"')) <> 'NULL')) > 0)
     OR (kind = 'redirect' AND (json_type(val) IN ('BIGINT', 'UBIGINT', 'DOUBLE')
         OR json_type(val) = 'VARCHAR' AND trim(val->>'$') <> '' AND NOT regexp_matches(val->>'$', '^\s*[\{\[]')))
)
"""


def _flat_sql(kind: str) -> str:
    columns = []
    for c, t in NODE_COLUMNS[kind].items():
        text = f"json_extract_string(val, '$.{c}')"
        if c == "id":
            text = f"CASE WHEN json_type(val) = 'OBJECT' THEN {text} ELSE val->>'$' END"
        elif kind == "redirect":
            text = f"CASE WHEN json_type(val) = 'OBJECT' THEN {text} END"
        columns.append((text if t == "string" else f"TRY_CAST({text} AS {t})") + f" AS {c}")
    return f"{_NODES} SELECT record_id, parent_path, node_path, {', '.join(columns)} FROM nodes WHERE kind = '{kind}'"


_P3_REGIONS = """
WITH l AS (SELECT feed_row_id, location.bounding_box AS b, row_number() OVER (PARTITION BY mdb_source_id ORDER BY loaded_at DESC NULLS LAST, feed_row_id DESC) AS k FROM schedule_feeds WHERE mdb_source_id IS NOT NULL),
u AS (SELECT feed_row_id, least(b.minimum_latitude, b.maximum_latitude) AS s, greatest(b.minimum_latitude, b.maximum_latitude) AS n, b.minimum_longitude AS w, b.maximum_longitude AS e FROM l WHERE k = 1
 AND b.minimum_latitude BETWEEN -90 AND 90 AND b.maximum_latitude BETWEEN -90 AND 90 AND b.minimum_longitude BETWEEN -180 AND 180 AND b.maximum_longitude BETWEEN -180 AND 180
 AND NOT (b.minimum_latitude = 0 AND b.maximum_latitude = 0 AND b.minimum_longitude = 0 AND b.maximum_longitude = 0)),
r AS (SELECT *, (CASE WHEN w > e THEN e - w + 360 ELSE e - w END) * (n - s) AS area FROM u),
p AS (SELECT box_id, (minimum_latitude + maximum_latitude) / 2 AS lat, (minimum_longitude + maximum_longitude) / 2 AS mid, minimum_longitude > maximum_longitude AS across FROM box_log
 WHERE minimum_latitude BETWEEN -90 AND 90 AND maximum_latitude BETWEEN -90 AND 90 AND minimum_longitude BETWEEN -180 AND 180 AND maximum_longitude BETWEEN -180 AND 180
 AND NOT (minimum_latitude = 0 AND maximum_latitude = 0 AND minimum_longitude = 0 AND maximum_longitude = 0)),
q AS (SELECT box_id, lat, CASE WHEN NOT across THEN mid WHEN mid >= 0 THEN mid - 180 ELSE mid + 180 END AS lon FROM p)
SELECT box_id, arg_min(feed_row_id, (area, feed_row_id)) AS feed_row_id FROM q LEFT JOIN r ON lat BETWEEN s AND n AND CASE WHEN w > e THEN lon >= w OR lon <= e ELSE lon BETWEEN w AND e END GROUP BY box_id
"""
_P3 = f"""
WITH b AS (
  SELECT box_id, mdb_source_id, radians((minimum_latitude + maximum_latitude) / 2) AS lat,
    radians(CASE WHEN minimum_longitude > maximum_longitude
      THEN (minimum_longitude + maximum_longitude) / 2 + CASE WHEN minimum_longitude + maximum_longitude >= 0 THEN -180 ELSE 180 END
      ELSE (minimum_longitude + maximum_longitude) / 2 END) AS lon
  FROM box_log
  WHERE abs(minimum_latitude) <= 90 AND abs(maximum_latitude) <= 90 AND abs(minimum_longitude) <= 180 AND abs(maximum_longitude) <= 180
    AND NOT (minimum_latitude = 0 AND maximum_latitude = 0 AND minimum_longitude = 0 AND maximum_longitude = 0)
), c AS (SELECT *, CAST(floor(degrees(lat) / 0.001) AS BIGINT) AS band FROM b),
n AS (SELECT *, unnest([band - 1, band, band + 1]) AS near_band FROM c)
SELECT p.box_id AS box_a, q.box_id AS box_b
FROM c p JOIN n q ON p.band = q.near_band AND p.box_id < q.box_id AND p.mdb_source_id <> q.mdb_source_id
WHERE 2 * 6371.0088 * asin(sqrt(least(1, pow(sin((p.lat - q.lat) / 2), 2) + cos(p.lat) * cos(q.lat) * pow(sin((p.lon - q.lon) / 2), 2)))) <= {NEAR_KM}
"""

_P4 = r"""
WITH f AS (
  SELECT src_row, unnest([{'field': 'features', 'txt': features}, {'field': 'entity_type', 'txt': entity_type},
                          {'field': 'static_reference', 'txt': static_reference}, {'field': 'redirect.id', 'txt': redirect.id}]) AS x FROM sources
), t AS (
  SELECT src_row, x.field AS field, list_filter(list_transform(list_filter(
    regexp_extract_all(regexp_replace(x.txt, '^\s*\[(.*)\]\s*$', '\1', 's'), '"(?:[^"]|"")*"|''[^'']*''|[^\s|;,/+&"'']+'),
    lambda w: lower(w) <> 'and'),
    lambda w: trim(CASE WHEN w[1] = '"' THEN replace(w[2:-2], '""', '"') WHEN w[1] = '''' THEN w[2:-2] ELSE w END)), lambda w: w <> '') AS items
  FROM f
)
SELECT src_row, field, CAST(pos AS INTEGER) AS pos, items[pos] AS item
FROM (SELECT src_row, field, items, unnest(range(1, len(items) + 1)) AS pos FROM t WHERE len(items) >= 2)
"""

_WALK = r"""
WITH RECURSIVE latest AS (
  SELECT mdb_source_id, list_filter(list_transform(redirect, lambda r: regexp_replace(r.id, '^\s+|\s+$', '', 'g')), lambda i: i IS NOT NULL AND i NOT IN ('', 'None'))[1] AS parent
  FROM schedule_feeds WHERE mdb_source_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY mdb_source_id ORDER BY loaded_at DESC, feed_row_id DESC) = 1
), e AS (SELECT mdb_source_id AS id, parent FROM latest WHERE parent IS NOT NULL),
w(id, cur, path, looped) AS (
  SELECT id, parent, [id, parent], parent = id FROM e
  UNION ALL
  SELECT w.id, e.parent, list_append(w.path, e.parent), list_contains(w.path, e.parent) FROM w JOIN e ON w.cur = e.id WHERE NOT w.looped
), ends AS (SELECT w.* FROM w LEFT JOIN e ON w.cur = e.id WHERE w.looped OR e.id IS NULL)
"""

PARSED_FORM = r"""
WITH l AS (
  SELECT line_id, line, coalesce(regexp_full_match(line, '(?:"(?:[^"]|"")*"|[^",\r\n]*)(?:,(?:"(?:[^"]|"")*"|[^",\r\n]*))*'), true) AS sound,
    regexp_extract_all(',' || coalesce(line, ''), ',("(?:[^"]|"")*"|[^",\r\n]*)', 1) AS raw
  FROM form_lines
), f AS (
  SELECT line_id, sound, list_transform(raw, lambda x: CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END) AS fields FROM l
), g AS (
  SELECT *, regexp_replace(fields[3], '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS provider_, regexp_replace(fields[7], '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS url_ FROM f
), judged AS (
  SELECT *, CASE WHEN NOT sound THEN 'quoting' WHEN len(fields) <> 19 THEN 'columns'
    WHEN (provider_ <> '' AND (provider_[1] = '#' OR NOT regexp_matches(provider_, '\p{L}')))
      OR (url_ <> '' AND NOT regexp_matches(url_, '^https?://[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+(?::[0-9]+)?(?:[/?#][^\s\p{Z}]*)?$'))
      OR regexp_matches(fields[16], '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{FFFD}]') THEN 'value' END AS reason
  FROM g
)
"""


def oracle_sql() -> dict[str, str]:
    text = [(i + 1, c) for i, c in enumerate(form.FORM_FIELDS) if c not in ("clientError", "timestamp", "auth_type")]
    day = "CAST(coalesce(try_strptime(fields[2], '%Y-%m-%d'), try_strptime(fields[2], '%m/%d/%Y')) AS DATE)"
    auth = 1 + form.FORM_FIELDS.index("auth_type")
    return {
        "p1_found": f"{_NODES} SELECT record_id, parent_path, node_path FROM nodes",
        **{f"p1_{kind}": _flat_sql(kind) for kind in NODE_COLUMNS},
        "p3_found": _P3,
        "p3_regions": _P3_REGIONS,
        "p4_found": _P4,
        "p5_found": f"{_WALK} SELECT id AS mdb_source_id, CASE WHEN looped THEN '' ELSE cur END AS root_id, CAST(CASE WHEN looped THEN -1 ELSE len(path) - 1 END AS INTEGER) AS depth FROM ends",
        "p5_paths": f"{_WALK} SELECT id AS mdb_source_id, array_to_string(path, '>') AS path, cur AS root_id, CAST(len(path) - 1 AS INTEGER) AS depth FROM ends WHERE NOT looped",
        "p5_descendants": f"{_WALK} SELECT path[n] AS ancestor, id AS descendant, CAST(n - 1 AS INTEGER) AS steps FROM (SELECT id, path, unnest(range(2, len(path) + 1)) AS n FROM ends WHERE NOT looped)",
        "p5_loops": f"{_WALK} SELECT id AS mdb_source_id, list_min(path) AS loop_id, CAST(len(path) - 1 AS BIGINT) AS loop_size FROM ends WHERE looped AND cur = id",
        "p6_found": f"{PARSED_FORM} SELECT line_id, reason FROM judged WHERE reason IS NOT NULL",
        "p6_good": f"{PARSED_FORM} SELECT line_id, {day} AS day, {', '.join(f'nullif(fields[{i}], {chr(39) * 2}) AS {c}' for i, c in text)}, TRY_CAST(trim(fields[{auth}]) AS INTEGER) AS auth_type FROM judged WHERE reason IS NULL",
    }
