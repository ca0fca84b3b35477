"""Whole runs over a folder of datasets: rule compliance, and features and status for the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as pr
from ..functions import text as tx
from ..operators import quality
from ..schema import BOX_CORNERS, REPORT, SCHEDULE
from ..session import cut
from ..sources import gtfs

# The members whose rows decide a feature. Some differ from the standard's names, as the catalog's own scripts do.
FEATURE_MEMBERS = {"pathways": "pathways.txt", "fares-v1": "fares_attributes.txt", "fares-v2": "fares_products.txt", "areas": "areas.txt", "groups": "location_groups.txt", "shapes": "locations.geojson", "bookings": "bookings_rules.txt"}


def _per_dataset(datasets: DataFrame, facts: list[DataFrame]) -> DataFrame:
    for f in facts:
        datasets = datasets.join(f, "dataset_id", "left")
    return datasets


def _quantified(members: DataFrame, member: str, tests: dict[str, tuple[str, bool]]) -> DataFrame:
    """(dataset_id, the tests): whether a column of the member is all there (or, if the flag is set, all missing); false where
    the member lacks the column, true for no rows."""
    columns = sorted({c for c, _ in tests.values()})
    rows = gtfs.member_of(members, member, {c: "string" for c in columns})
    data = F.col("line_no") > 0
    out = []
    for name, (c, missing) in tests.items():
        value = F.when(data, F.col(c).isNull() if missing else F.col(c).isNotNull())
        out.append((F.coalesce(F.bool_and(value), F.lit(True)) & F.bool_or((F.col("line_no") == 0) & F.array_contains("header", c))).alias(name))
    return rows.groupBy("dataset_id").agg(*out)


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """(report, notices): a validator's reports, one a folder, named by it."""
    rows = spark.read.schema(REPORT).option("multiLine", True).option("recursiveFileLookup", True).json(folder)
    return rows.select(F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"([^/]+)/[^/]+$", 1).alias("report"), "notices")


def dataset_facts(spark: SparkSession, folder: str, reports: DataFrame | None = None) -> DataFrame:
    """One row for each dataset with everything that the rules ask; a dataset without a report has null notices.

    ``reports``: (dataset_id, notices).
    """
    manifest = gtfs.read_manifest(spark, folder)
    datasets = manifest.select("dataset_id").distinct()
    # each zip is opened once
    members = cut(gtfs.read_members(spark, folder, ["routes.txt", "feed_info.txt", "trips.txt", "frequencies.txt", "stop_times.txt", "shapes.txt"]))
    routes = _quantified(members, "routes.txt", {"all_short_names": ("route_short_name", False), "no_long_names": ("route_long_name", True)})
    info = _quantified(members, "feed_info.txt", {"no_contact_url": ("feed_contact_url", True), "all_contact_emails": ("feed_contact_email", False), "no_contact_email": ("feed_contact_email", True), "all_contact_urls": ("feed_contact_url", False)})
    trips = gtfs.member_of(members, "trips.txt", {"trip_id": "string", "shape_id": "string"})
    frequencies = gtfs.member_of(members, "frequencies.txt", {"trip_id": "string"})
    both = gtfs.with_columns(trips, ["block_id", "trip_id"]).filter("has_columns").join(gtfs.with_columns(frequencies, ["trip_id"]).filter("has_columns").select("dataset_id"), "dataset_id").select("dataset_id")
    within = quality.all_within(gtfs.data_rows(trips), "trip_id", gtfs.data_rows(frequencies), "trip_id", "dataset_id")
    blocks = both.join(within, "dataset_id", "left").select("dataset_id", F.coalesce("all_in", F.lit(True)).alias("blocks_in_frequencies"))
    stops = gtfs.member_of(members, "stop_times.txt", {"trip_id": "string", "shape_dist_traveled": "double"})
    shapes = gtfs.member_of(members, "shapes.txt", {"shape_id": "string", "shape_dist_traveled": "double"})
    beyond = exceeded(trips, stops, shapes).groupBy("dataset_id").agg((F.count(F.lit(1)) > 0).alias("exceeded"))
    folders = gtfs.sub_directories(manifest).select("dataset_id", F.lit(True).alias("has_folders"))
    facts = _per_dataset(datasets, [routes, info, blocks, beyond, folders])
    return facts.join(reports, "dataset_id", "left") if reports is not None else facts.withColumn("notices", F.lit(None).cast(REPORT["notices"].dataType))


def exceeded(trips: DataFrame, stops: DataFrame, shapes: DataFrame) -> DataFrame:
    """Trips of each dataset whose stops go beyond their shape."""
    return quality.exceeded_distance(gtfs.data_rows(trips), gtfs.data_rows(stops), gtfs.data_rows(shapes), ["dataset_id"])


def compliance(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verdicts of the twelve best practices, of the two bad ones), a row for each dataset."""
    names = ("all_short_names", "no_long_names", "no_contact_url", "all_contact_emails", "no_contact_email", "all_contact_urls", "blocks_in_frequencies")
    best = quality.best_practices(F.col("notices"), {n: F.col(n) for n in names})
    return quality.verdicts(facts, "dataset_id", best), quality.verdicts(facts, "dataset_id", quality.bad_practices(F.col("has_folders"), F.col("exceeded")))


def results(verdicts: DataFrame, n_rules: int) -> tuple[DataFrame, DataFrame]:
    """(the datasets that passed each rule, packed to the top; how many)."""
    rules = [f"rule_{i}" for i in range(1, n_rules + 1)]
    packed = quality.packed_columns(quality.verdicts_long(verdicts, "dataset_id", n_rules).filter("passed"), "dataset_id", "rule", rules)
    return packed, quality.filled_counts(packed, rules)


def _enough_lines(members: DataFrame, member: str, n: int, name: str) -> DataFrame:
    """Counts physical lines, as the header counts too."""
    rows = gtfs.member_of(members, member, {})
    return rows.groupBy("dataset_id").agg((F.count(F.lit(1)) >= n).alias(name))


def refresh(spark: SparkSession, folder: str, now: str) -> DataFrame:
    """(dataset_id, features, status) as a patch for the catalog: the features that the members show, null for none; inactive where
    no service date is within 26 weeks before ``now``, else null, which keeps what was there."""
    manifest = gtfs.read_manifest(spark, folder)
    datasets = manifest.select("dataset_id").distinct()
    members = cut(gtfs.read_members(spark, folder, [*FEATURE_MEMBERS.values(), "stop_times.txt", "calendar.txt"]))
    counts = [_enough_lines(members, FEATURE_MEMBERS[k], 4 if k == "bookings" else 2, k.replace("-", "_")) for k in ("pathways", "fares-v1", "fares-v2", "groups", "shapes", "bookings")]
    times = gtfs.data_rows(gtfs.member_of(members, "stop_times.txt", {"start_service_area_id": "string", "start_service_area_radius": "string"}))
    flex = times.groupBy("dataset_id").agg(pr.any_defined(F.col("start_service_area_id"), F.col("start_service_area_radius")).alias("flexible"))
    calendar = gtfs.data_rows(gtfs.member_of(members, "calendar.txt", {"end_date": "string"}))
    recent = calendar.groupBy("dataset_id").agg(tx.recent(F.col("end_date"), F.lit(now).cast("timestamp")).alias("recent"))
    facts = gtfs.members_there(_per_dataset(datasets, [*counts, flex, recent]), manifest, FEATURE_MEMBERS["areas"], "has_areas")
    yes = lambda c: pr.sure(F.col(c))
    tags = quality.feature_tags({"pathways": yes("pathways"), "fares-v1": yes("fares_v1"), "fares-v2": yes("fares_v2"), "flex-v1": yes("has_areas") & yes("flexible"), "flex-v2": yes("groups") | yes("shapes") | yes("bookings")})
    return facts.select("dataset_id", tags.alias("features"), quality.derived_status(F.col("recent")).alias("status"))


def bounding_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset_id, four corners) of each dataset's stops, null where they are unusable."""
    stops = gtfs.read_member(spark, folder, "stops.txt", {"stop_lat": "double", "stop_lon": "double"})
    boxes = quality.bounding_boxes(gtfs.data_rows(stops), ["dataset_id"], F.col("stop_lat"), F.col("stop_lon"))
    return gtfs.read_manifest(spark, folder).select("dataset_id").distinct().join(boxes, "dataset_id", "left")


def built(rows: DataFrame, boxes: DataFrame, now: str, url_template: str) -> DataFrame:
    """(the columns of a schedule row, file_name) of new sources built from their datasets.

    ``rows``: ``dataset_id`` and any of the catalog's fields, flat (``provider``, ``country_code``, ``direct_download`` and so on).
    ``boxes``: (dataset_id, four corners) of the datasets that can be read, as from ``bounding_boxes``; rows of others are left out.
    A missing subdivision is ``unknown`` in the file's name; redirects without a usable id are left out.
    """
    known = rows.join(boxes, "dataset_id")
    have = set(rows.columns)
    field = lambda n, t="string": (F.col(n) if n in have else F.lit(None)).cast(t)
    name = lambda extension: tx.filename(field("country_code"), F.coalesce(field("subdivision_name"), F.lit("unknown")), field("provider"), F.lit("gtfs"), field("mdb_source_id"), extension)
    box = F.struct(*[F.col(c) for c in BOX_CORNERS], F.lit(now).alias("extracted_on"))
    values = {
        "data_type": F.lit("gtfs"),
        "location": F.struct(*[field(c).alias(c) for c in ("country_code", "subdivision_name", "municipality")], box.alias("bounding_box")),
        "urls": F.struct(*[(tx.latest_url(name("zip"), url_template) if f.name == "latest" else field(f.name, f.dataType)).alias(f.name) for f in SCHEDULE["urls"].dataType.fields]),
        "redirect": pr.usable_redirects(field("redirect", SCHEDULE["redirect"].dataType)),
    }
    return known.select(*[values.get(f.name, field(f.name, f.dataType)).cast(f.dataType).alias(f.name) for f in SCHEDULE.fields], name("json").alias("file_name"))


def update_patch(rows: DataFrame, boxes: DataFrame, now: str) -> DataFrame:
    """(schedule columns) as a patch for ``Sources.updated``: as ``built``, but a new ``direct_download`` counts only where its
    dataset can be read, and brings its box then; all else that is null keeps what was there. Redirects are made text and those
    without an id left out."""
    have = set(rows.columns)
    field = lambda n, t="string": (F.col(n) if n in have else F.lit(None)).cast(t)
    joined = rows.join(boxes.withColumn("__readable", F.lit(True)), "dataset_id", "left")
    new = F.col("__readable") & field("direct_download").isNotNull()
    box = F.when(new, F.struct(*[F.col(c) for c in BOX_CORNERS], F.lit(now).alias("extracted_on")))
    values = {
        "location": F.struct(*[field(c).alias(c) for c in ("country_code", "subdivision_name", "municipality")], box.alias("bounding_box")),
        "urls": F.struct(*[(F.when(new, field(f.name)) if f.name == "direct_download" else field(f.name, f.dataType)).cast(f.dataType).alias(f.name) for f in SCHEDULE["urls"].dataType.fields]),
        "redirect": pr.usable_redirects(field("redirect", SCHEDULE["redirect"].dataType)),
    }
    return joined.select(*[values.get(f.name, field(f.name, f.dataType)).cast(f.dataType).alias(f.name) for f in SCHEDULE.fields])
