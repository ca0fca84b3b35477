"""Lookups against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task may hold; a key of more is hot.
HOT_ROWS = 250_000
#: Most hot keys: beyond so many times HOT_ROWS rows the limit grows, by at most a ten-thousandth of the rows.
HOT_KEYS = 10_000
#: Most parts that a hot key is divided into.
MOST_SALTS = 4_096


class Hot(list):
    """The hot keys, and into how many parts the rows of each go."""

    def __init__(self, keys: list, salts: int = 64):
        super().__init__(keys)
        self.salts = salts


def hot_keys(df: DataFrame, key: str, rows: int, least: int | None = None) -> Hot:
    """The hot keys among ``rows`` rows, at most ``HOT_KEYS``; the count is pre-aggregated before its shuffle."""
    least = HOT_ROWS if least is None else least
    if rows <= least:
        return Hot([])
    limit = max(least, rows // HOT_KEYS)
    found = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > limit).collect()
    most = max((r["count"] for r in found), default=0)
    return Hot([r[0] for r in found], min(MOST_SALTS, max(2, -(-most // limit))))


def salted_lookup(left: DataFrame, right: DataFrame, key: str, other: str, spread_by: str, hot: Hot, how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` on left.key = right.other.

    Rows of hot keys are spread over ``hot.salts`` parts by a hash of ``spread_by``; only the hot keys' rows of ``right`` are
    repeated. Null keys match nothing and are spread likewise.
    """
    if not hot:
        return left.join(right, left[key] == right[other], how)
    many = F.col(key).isin(hot) | F.col(key).isNull()
    salted = left.withColumn("__salt", F.when(many, F.pmod(F.xxhash64(spread_by), F.lit(hot.salts))).otherwise(F.lit(0)).cast("int"))
    parts = F.when(F.col(other).isin(hot), F.sequence(F.lit(0), F.lit(hot.salts - 1))).otherwise(F.array(F.lit(0)))
    spread = right.withColumn("__part", F.explode(parts))
    return salted.join(spread, (salted[key] == spread[other]) & (salted["__salt"] == spread["__part"]), how).drop("__salt", "__part")
