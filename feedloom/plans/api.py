"""The catalog as users ask it: both kinds of feeds, filtered, added to and updated.

Schedule rows are judged by their own fields; realtime rows by the schedule rows that they refer to, any of which may meet the
condition. Every answer is one DataFrame of both kinds, realtime rows overriding schedule rows of the same id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as pr
from ..functions.text import id_order
from ..operators import lookup, merge
from ..schema import BOX_CORNERS, DATA_TYPES

KEY = "mdb_source_id"


@dataclass(frozen=True)
class Sources:
    """``schedule`` and ``realtime``: rows as in ``schema.SCHEDULE`` and ``schema.REALTIME``, unique in their id."""

    schedule: DataFrame
    realtime: DataFrame

    def _of(self, data_type: str | None, own: Column | None, live: DataFrame) -> DataFrame:
        if data_type is not None and data_type not in DATA_TYPES:
            raise ValueError(f"no such data type: {data_type!r}; it is one of {', '.join(DATA_TYPES)}")
        parts = []
        if data_type in (None, "gtfs"):
            parts.append(self.schedule if own is None else self.schedule.filter(own))
        if data_type in (None, "gtfs-rt"):
            parts.append(live)
        return merge.override_union(parts, KEY) if len(parts) > 1 else parts[0]

    def _referring(self, condition: Column, own: Column | None = None) -> DataFrame:
        return lookup.any_reference(self.realtime, KEY, "static_reference", self.schedule, KEY, condition, own)

    def ordered(self, df: DataFrame) -> DataFrame:
        """By id, numeric ones first; for output only, since every later operation loses the order."""
        return df.orderBy(*id_order(F.col(KEY)))

    def all(self, data_type: str | None = None) -> DataFrame:
        return self._of(data_type, None, self.realtime)

    def one(self, source_id: str) -> DataFrame:
        return self.all().filter(F.col(KEY) == str(source_id))

    def by_bounding_box(self, minimum_latitude: float, maximum_latitude: float, minimum_longitude: float, maximum_longitude: float, data_type: str | None = None) -> DataFrame:
        box = tuple(F.col(f"location.bounding_box.{c}") for c in BOX_CORNERS)
        meets = pr.overlapping_boxes(box, (minimum_latitude, maximum_latitude, minimum_longitude, maximum_longitude))
        return self._of(data_type, meets, self._referring(meets))

    def by_country_code(self, country_code: str | None, data_type: str | None = None) -> DataFrame:
        meets = pr.same(F.col("location.country_code"), country_code)
        return self._of(data_type, meets, self._referring(meets))

    def by_subdivision_name(self, subdivision_name: str | None, data_type: str | None = None) -> DataFrame:
        meets = pr.same(F.col("location.subdivision_name"), subdivision_name)
        return self._of(data_type, meets, self._referring(meets))

    def by_feature(self, feature: str, data_type: str | None = None) -> DataFrame:
        """A realtime row may also have the feature itself."""
        meets = pr.has_feature(F.col("features"), feature)
        return self._of(data_type, meets, self._referring(meets, meets))

    def by_status(self, status: str | None, data_type: str | None = None) -> DataFrame:
        meets = pr.has_status(F.col("status"), status)
        return self._of(data_type, meets, self.realtime.filter(meets))

    def by_is_official(self, is_official: str | None, data_type: str | None = None) -> DataFrame:
        meets = pr.same(F.col("is_official"), is_official)
        return self._of(data_type, meets, self.realtime.filter(meets))

    def by_is_stable(self, data_type: str | None = None) -> DataFrame:
        """Realtime rows without the flag count as stable."""
        meets = pr.is_stable(F.col("is_producer_url_unstable"))
        return self._of(data_type, meets, self.realtime.filter(meets) if "is_producer_url_unstable" in self.realtime.columns else self.realtime)

    def latest_datasets(self) -> DataFrame:
        """(id, latest) of the schedule rows that have one."""
        return self.schedule.filter(pr.has_latest(F.col("data_type"), F.col("urls.latest"))).select(KEY, F.col("urls.latest").alias("latest"))

    def updated(self, patch: DataFrame, data_type: str) -> Sources:
        """With the patch's values that aren't null; rows of unknown ids are ignored."""
        if data_type == "gtfs":
            return Sources(merge.patch_merge(self.schedule, patch, KEY), self.realtime)
        return Sources(self.schedule, merge.patch_merge(self.realtime, patch, KEY))

    def with_added(self, rows: DataFrame, data_type: str) -> Sources:
        if data_type == "gtfs":
            return Sources(merge.append_entities(self.schedule, rows, KEY), self.realtime)
        return Sources(self.schedule, merge.append_entities(self.realtime, rows, KEY))

    def next_id(self) -> DataFrame:
        """An id that no row has."""
        return merge.next_id(self.schedule, self.realtime, key=KEY)
