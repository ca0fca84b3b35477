"""Profiles and rules of datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import number_or_null, sure
from ..functions.shapes import relative_difference
from .ordered import row_numbers


def bounding_boxes(stops: DataFrame, by: Sequence[str], lat: Column, lon: Column) -> DataFrame:
    """(by, four corners): all null where either column has no value at all; NaN counts as missing. Without ``by`` the box of
    everything, one row even for no rows."""
    rows = stops.select(*by, number_or_null(lat.cast("double")).alias("__a"), number_or_null(lon.cast("double")).alias("__o"))
    known = (F.count("__a") > 0) & (F.count("__o") > 0)
    corners = [F.when(known, f(c)).alias(n) for f, c, n in ((F.min, "__a", "minimum_latitude"), (F.max, "__a", "maximum_latitude"), (F.min, "__o", "minimum_longitude"), (F.max, "__o", "maximum_longitude"))]
    return rows.groupBy(*by).agg(*corners)


def all_within(left: DataFrame, left_key: str, right: DataFrame, right_key: str, by: str) -> DataFrame:
    """(by, all_in): of each group of ``left`` whether every key occurs in the same group of ``right``; a null key counts as in
    where ``right`` has one too."""
    seen = right.select(F.col(by).alias("__g"), F.col(right_key).alias("__k")).distinct()
    keys = left.select(by, left_key).distinct()
    out = keys.join(seen, (keys[by] == seen["__g"]) & keys[left_key].eqNullSafe(seen["__k"]), "left_anti").select(F.col(by).alias("__g")).distinct()
    groups = left.select(by).distinct()
    return groups.join(out, groups[by] == out["__g"], "left").select(by, F.col("__g").isNull().alias("all_in"))


def exceeded_distance(trips: DataFrame, stop_times: DataFrame, shapes: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(extra, trip_id, shape_id, max_stop_times, max_shapes, relative_diff) of trips whose stops go beyond their shape.

    Both sides are reduced to their maxima before the join of the two; null keys and NaN distances are left out. ``extra`` are
    key columns that all three share, such as the dataset.
    """
    d = number_or_null(F.col("shape_dist_traveled").cast("double"))
    stops = stop_times.groupBy(*extra, "trip_id").agg(F.max(d).alias("max_stop_times")).filter("trip_id IS NOT NULL AND max_stop_times IS NOT NULL")
    own = trips.select(*extra, "trip_id", "shape_id").filter("trip_id IS NOT NULL AND shape_id IS NOT NULL").distinct()
    limits = shapes.filter("shape_id IS NOT NULL").groupBy(*extra, "shape_id").agg(F.max(d).alias("max_shapes"))
    joined = own.join(stops, [*extra, "trip_id"]).join(limits, [*extra, "shape_id"]).filter("max_stop_times > max_shapes")
    return joined.select(*extra, "trip_id", "shape_id", "max_stop_times", "max_shapes", relative_difference(F.col("max_stop_times"), F.col("max_shapes")).alias("relative_diff"))


def no_notice(notices: Column, code: str, file: str | None, field: str | None) -> Column:
    """True unless a validator's report complains: no notice of the code at all; else of the first such notice's samples, none of
    the file (without ``field``), or not both some of the file and some of the field. A missing report is false."""
    of_code = F.filter(notices, lambda n: n["code"] == code)
    samples = F.get(of_code, F.lit(0))["sampleNotices"]
    some_file = sure(F.exists(samples, lambda s: sure(s["filename"] == (file or ""))))
    verdict = F.lit(True) if file is None else ~some_file
    if field is not None:
        has_names = sure(F.exists(samples, lambda s: s["fieldName"].isNotNull())) & sure(F.exists(samples, lambda s: s["filename"].isNotNull()))
        verdict = has_names & ~(some_file & sure(F.exists(samples, lambda s: sure(s["fieldName"] == field))))
    return F.when(notices.isNull(), False).when(F.size(of_code) == 0, True).otherwise(verdict)


@dataclass(frozen=True)
class Rule:
    """A rule as data: the member and field it is about, what it asks, and its verdict as a column of a dataset's facts."""

    file: str
    field: str
    asks: str
    verdict: Column


def feature_tags(tests: Mapping[str, Column]) -> Column:
    """The names whose test holds, in order; null instead of none."""
    found = F.filter(F.array(*[F.when(sure(t), F.lit(name)) for name, t in tests.items()]), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, found)


def derived_status(recent: Column) -> Column:
    """inactive unless recent; never active."""
    return F.when(~sure(recent), F.lit("inactive"))


def best_practices(notices: Column, facts: Mapping[str, Column]) -> list[Rule]:
    """The twelve rules. ``facts``: boolean columns all_short_names, no_long_names, no_contact_url, all_contact_emails,
    no_contact_email, all_contact_urls, blocks_in_frequencies."""
    field, missing = "missing_recommended_field", "missing_recommended_file"
    reported = [("routes.txt", "agency_id"), ("agency.txt", "agency_id"), ("fare_attributes.txt", "agency_id")]
    dated = [("feed_info.txt", f) for f in ("feed_start_date", "feed_end_date", "feed_version")]
    return [
        Rule("routes.txt", "route_short_name", "all short names and no long names", sure(facts["all_short_names"]) & sure(facts["no_long_names"])),
        *[Rule(f, c, "an agency id where there is one agency", no_notice(notices, field, f, c)) for f, c in reported],
        Rule("feed_info.txt", "", "the file, unless there are translations", no_notice(notices, missing, "feed_info.txt", None)),
        *[Rule(f, c, "the field is filled", no_notice(notices, field, f, c)) for f, c in dated],
        Rule("feed_info.txt", "feed_contact_email", "an e-mail and no url", sure(facts["no_contact_url"]) & sure(facts["all_contact_emails"])),
        Rule("feed_info.txt", "feed_contact_url", "a url and no e-mail", sure(facts["no_contact_email"]) & sure(facts["all_contact_urls"])),
        Rule("stop_times.txt", "timepoint", "the column is there", no_notice(notices, "missing_timepoint_column", "stop_times.txt", None)),
        Rule("trips.txt", "block_id", "trips are among the frequencies", sure(facts["blocks_in_frequencies"])),
    ]


def bad_practices(has_folders: Column, exceeded: Column) -> list[Rule]:
    return [
        Rule("zip", "", "a folder within the dataset", sure(has_folders)),
        Rule("", "shape_dist_traveled", "stops beyond the end of their shape", sure(exceeded)),
    ]


def verdicts(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """(key, rule_1 .. rule_n): one boolean column for each rule, in one pass."""
    return df.select(key, *[r.verdict.alias(f"rule_{i}") for i, r in enumerate(rules, 1)])


def verdicts_long(wide: DataFrame, key: str, n_rules: int) -> DataFrame:
    """(key, rule, passed)."""
    return wide.select(key, F.explode(F.array(*[F.struct(F.lit(f"rule_{i}").alias("rule"), F.col(f"rule_{i}").alias("passed")) for i in range(1, n_rules + 1)])).alias("r")).select(key, "r.*")


def packed_columns(passed: DataFrame, key: str, rule: str, rules: Sequence[str]) -> DataFrame:
    """(n, one column for each rule): the keys that passed each rule, from the top in order, the rest null; a rule without any is
    all null. Rows are numbered part by part, not rule by rule, so a rule that nearly all pass is no single task."""
    numbered = row_numbers(passed.select(rule, key), [rule, key], "row_no")
    # one row a rule
    first = numbered.groupBy(rule).agg(F.min("row_no").alias("__first"))
    placed = numbered.join(F.broadcast(first), rule).withColumn("n", (F.col("row_no") - F.col("__first") + 1).cast("int"))
    return placed.groupBy("n").pivot(rule, list(rules)).agg(F.first(key))


def filled_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns])


def repeated(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of the values that occur more than once."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def contiguous(df: DataFrame, key: str) -> DataFrame:
    """(contiguous): the numeric ids are 1 to n, each once; true for no rows."""
    n = F.col(key).cast("string").try_cast("bigint")
    low, high, count, distinct = F.min(n), F.max(n), F.count(F.lit(1)), F.countDistinct(n)
    return df.agg(F.coalesce((low == 1) & (high == count) & (distinct == count), count == 0).alias("contiguous"))
