"""The flat export of both catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shapes, text
from ..schema import EXPORT_COLUMNS
from .lookup import UNKNOWN, first_reference


def export_rows(catalog: DataFrame, schedule: DataFrame) -> DataFrame:
    """The export's columns, dotted, all in order; missing ones null.

    Realtime rows take the location of their first static reference's row, unknown names where they have no reference; arrays
    are piped, redirects split in ids and comments, top-level texts stripped.
    """
    place = catalog.schema["location"].dataType
    unknown = F.struct(*[(F.lit(UNKNOWN) if f.name in ("country_code", "subdivision_name", "municipality") else F.lit(None)).cast(f.dataType).alias(f.name) for f in place.fields])
    # of the rows of an id any one's location serves; ids are unique in a catalog
    places = schedule.select(F.col("mdb_source_id").alias("__sid"), "location").groupBy("__sid").agg(F.first("location", True).alias("location"))
    live = first_reference(catalog.filter("data_type = 'gtfs-rt'").withColumnRenamed("location", "__own"), "static_reference", places, "__sid", "location", unknown)
    live = live.withColumn("location", F.coalesce("location", "__own")).drop("__own")
    rows = catalog.filter("data_type <> 'gtfs-rt' OR data_type IS NULL").unionByName(live)
    rows = rows.withColumns({c: text.piped(F.col(c)) for c in ("static_reference", "entity_type", "features") if c in rows.columns})
    split = rows.select("*", F.struct(text.redirect_ids(F.col("redirect")).alias("id"), text.redirect_comments(F.col("redirect")).alias("comment")).alias("__r")).drop("redirect").withColumnRenamed("__r", "redirect")
    top = [f.name for f in split.schema.fields if f.dataType.typeName() == "string"]
    split = split.withColumns({c: text.strip(F.col(c)) for c in top})
    flat = shapes.flatten(split)
    return shapes.project(flat, EXPORT_COLUMNS)
