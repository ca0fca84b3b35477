"""Schemas of catalog rows; always declared, never inferred.

Ids are text everywhere: they are written as numbers or text, and some aren't numeric. Flags stay the texts ``True`` and
``False``. Where the reference's behaviour is an evident slip (a filter that can't fire, a threshold that returns nothing), the
intended meaning is the default and the literal one sits behind a ``compat`` argument.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


BOUNDING_BOX = T.StructType([*[T.StructField(n, T.DoubleType()) for n in ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude")], *_texts("extracted_on")])
LOCATION = T.StructType([*_texts("country_code", "subdivision_name", "municipality"), T.StructField("bounding_box", BOUNDING_BOX)])
URLS = T.StructType([*_texts("direct_download"), T.StructField("authentication_type", T.IntegerType()), *_texts("authentication_info", "api_key_parameter_name", "latest", "license")])
REDIRECT = T.ArrayType(T.StructType(_texts("id", "comment")))
TEXT_ARRAY = T.ArrayType(T.StringType())

SCHEDULE = T.StructType(
    [
        *_texts("mdb_source_id", "data_type", "provider", "name", "feed_contact_email"),
        T.StructField("features", TEXT_ARRAY),
        *_texts("status"),
        T.StructField("location", LOCATION),
        T.StructField("urls", URLS),
        T.StructField("redirect", REDIRECT),
        *_texts("is_official", "is_producer_url_unstable"),
    ]
)
#: With the keys that occur in files but that the normalized reader drops.
REALTIME = T.StructType(
    [
        *_texts("mdb_source_id", "data_type"),
        T.StructField("entity_type", TEXT_ARRAY),
        *_texts("provider", "name"),
        T.StructField("static_reference", TEXT_ARRAY),
        *_texts("note"),
        T.StructField("features", TEXT_ARRAY),
        *_texts("status"),
        T.StructField("urls", URLS),
        *_texts("is_official", "is_producer_url_unstable", "feed_contact_email", "license"),
        T.StructField("redirect", REDIRECT),
    ]
)
#: Keys of realtime rows that only the raw reader keeps.
REALTIME_RAW_ONLY = ("redirect", "feed_contact_email", "license", "is_producer_url_unstable")

# The enumerations.
DATA_TYPES = ("gtfs", "gtfs-rt")
STATUSES = ("active", "deprecated", "inactive", "development")
FEATURES = ("fares-v2", "fares-v1", "flex-v2", "flex-v1", "pathways", "occupancy")
ENTITY_TYPES = ("vp", "tu", "sa")
BOX_CORNERS = ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude")
#: The columns of the flat export, in order.
EXPORT_COLUMNS = (
    "mdb_source_id", "data_type", "entity_type", "location.country_code", "location.subdivision_name", "location.municipality", "provider",
    "is_official", "is_producer_url_unstable", "name", "note", "feed_contact_email", "static_reference", "urls.direct_download",
    "urls.authentication_type", "urls.authentication_info", "urls.api_key_parameter_name", "urls.latest", "urls.license",
    "location.bounding_box.minimum_latitude", "location.bounding_box.maximum_latitude", "location.bounding_box.minimum_longitude",
    "location.bounding_box.maximum_longitude", "location.bounding_box.extracted_on", "status", "features", "redirect.id", "redirect.comment",
)

#: A validator's report.
REPORT = T.StructType([T.StructField("notices", T.ArrayType(T.StructType([*_texts("code"), T.StructField("sampleNotices", T.ArrayType(T.StructType(_texts("filename", "fieldName"))))])))])
