"""Predicates as columns.

In a filter use them as they are; ``sure`` makes a projected or negated verdict two-valued.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sure(verdict: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(verdict, F.lit(False))


def same(c: Column, value: object) -> Column:
    """Equality in which null equals None; case counts."""
    return c.eqNullSafe(F.lit(value))


def overlapping_edges(low: Column, high: Column, other_low: Column | float, other_high: Column | float) -> Column:
    """Strict: edges that only touch don't overlap; null if any end is null."""
    return (high > other_low) & (low < other_high)


def overlapping_boxes(box: tuple[Column, Column, Column, Column], other: tuple[float | Column, float | Column, float | Column, float | Column]) -> Column:
    """Boxes as (min lat, max lat, min lon, max lon); strict on both axes; false if any corner is null.

    Two-valued by its null checks rather than by a wrapper, so that each part of it can be pushed to the scan.
    """
    verdict = F.lit(True)
    for corner in (*box, *other):
        if isinstance(corner, Column):
            verdict = verdict & corner.isNotNull()
    return verdict & overlapping_edges(box[0], box[1], other[0], other[1]) & overlapping_edges(box[2], box[3], other[2], other[3])


def has_feature(features: Column, feature: str) -> Column:
    """False for a null array."""
    return sure(F.array_contains(features, feature))


def has_status(status: Column, wanted: str | None) -> Column:
    """A missing status counts as active, and as None."""
    return same(status, wanted) | (status.isNull() & F.lit(wanted == "active"))


def is_stable(flag: Column) -> Column:
    """The producer's URL isn't flagged unstable."""
    return same(flag, "False") | flag.isNull()


def has_latest(data_type: Column, latest: Column) -> Column:
    return latest.isNotNull() & same(data_type, "gtfs")


def status_outside(status: Column, ignored: tuple[str, ...] = ("deprecated",)) -> Column:
    """A missing status is kept."""
    return status.isNull() | ~status.isin(*ignored)


def both_urls(direct: Column, latest: Column) -> Column:
    return direct.isNotNull() & latest.isNotNull()


def usable_redirects(redirect: Column) -> Column:
    """Without entries whose id is null or the text ``None``."""
    return F.filter(redirect, lambda r: r["id"].isNotNull() & (r["id"] != "None"))


#: Fixed value: what counts as a web address within a text.
WEB_ADDRESS = r"https?://(www\.)?[-a-zA-Z0-9@:%._+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b([-a-zA-Z0-9()@:%_+.~#?&/=]*)"


def valid_address(text: Column, empty: str = '""') -> Column:
    """The text, or the marker of an empty value where a text isn't blank and holds no web address."""
    return F.when((text != "") & ~text.rlike(WEB_ADDRESS), F.lit(empty)).otherwise(text)


def all_defined(c: Column) -> Column:
    """Aggregate: every value is there; true for no rows."""
    return F.coalesce(F.bool_and(c.isNotNull()), F.lit(True))


def all_undefined(c: Column) -> Column:
    """Aggregate: every value is missing; true for no rows."""
    return F.coalesce(F.bool_and(c.isNull()), F.lit(True))


def any_defined(*columns: Column) -> Column:
    """Aggregate: any of the columns holds a value."""
    verdict = F.lit(False)
    for c in columns:
        verdict = verdict | (F.count(c) > 0)
    return verdict


def at_least_lines(n: int, compat: bool = False) -> Column:
    """Aggregate: the file has n lines, its header among them. ``compat``: the threshold of four that never answers."""
    return F.lit(False) if compat else F.count(F.lit(1)) + 1 >= n


def number_or_null(c: Column) -> Column:
    """NaN as null, so that it neither wins a maximum nor passes a comparison."""
    return F.when(~F.isnan(c), c)
