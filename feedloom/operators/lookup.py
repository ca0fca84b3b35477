"""Lookups through arrays of references: explode and equi-join, never a join on array membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small

UNKNOWN = "unknown"


def references(df: DataFrame, key: str, refs: str) -> DataFrame:
    """(key, ref, position) for each reference, ids as trimmed text; null and empty arrays give none."""
    each = df.select(key, F.posexplode(refs).alias("position", "ref"))
    return each.select(key, F.trim(F.col("ref").cast("string")).alias("ref"), "position").filter(F.col("ref").isNotNull())


def resolve(df: DataFrame, key: str, refs: str, target: DataFrame, target_key: str, columns: list[str]) -> DataFrame:
    """(key, position, ref, found, columns): every reference with its row's columns, null where it dangles."""
    side = target.select(F.col(target_key).cast("string").alias("__t"), *[F.col(c) for c in columns])
    joined = references(df, key, refs).join(small(side), F.col("ref") == F.col("__t"), "left")
    return joined.select(key, "position", "ref", F.col("__t").isNotNull().alias("found"), *columns)


def dangling(df: DataFrame, key: str, refs: str, target: DataFrame, target_key: str) -> DataFrame:
    """(key, ref) of the references without a row."""
    side = target.select(F.col(target_key).cast("string").alias("__t"))
    return references(df, key, refs).join(small(side), F.col("ref") == F.col("__t"), "left_anti").select(key, "ref")


def any_reference(df: DataFrame, key: str, refs: str, target: DataFrame, target_key: str, condition: Column, own: Column | None = None) -> DataFrame:
    """The rows of ``df`` of whose references any meets ``condition`` (on ``target``'s columns), or which meet ``own``.

    The target is filtered first, then the exploded references are semi-joined; the keys found join back. Dangling references
    don't match. ``key`` must be unique.
    """
    side = target.filter(condition).select(F.col(target_key).cast("string").alias("__t")).distinct()
    keys = references(df, key, refs).join(small(side), F.col("ref") == F.col("__t"), "left_semi").select(F.col(key).alias("__k"))
    if own is not None:
        keys = keys.unionByName(df.filter(own).select(F.col(key).alias("__k")))
    return df.join(keys, df[key] == F.col("__k"), "left_semi")


def first_reference(df: DataFrame, refs: str, target: DataFrame, target_key: str, column: str, unreferenced: Column) -> DataFrame:
    """``df`` with ``column`` of the row of its first reference, null where that dangles; ``unreferenced`` where there is none
    at all."""
    side = target.select(F.col(target_key).cast("string").alias("__t"), F.col(column).alias("__v"))
    first = F.trim(F.get(refs, F.lit(0)).cast("string"))
    joined = df.withColumn("__first", first).join(small(side), F.col("__first") == F.col("__t"), "left")
    value = F.when(F.coalesce(F.size(refs), F.lit(0)) > 0, F.col("__v")).otherwise(unreferenced)
    return joined.withColumn(column, value).drop("__first", "__t", "__v")


def suffix_match(folders: DataFrame, folder: str, ids: DataFrame, key: str) -> DataFrame:
    """(key, folder): folders that end with a hyphen and an id, of ids with exactly one such folder.

    Every hyphened suffix of a folder's name is a candidate, so ids with hyphens join too, by equality.
    """
    parts = F.split(folder, "-")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "-"))
    each = folders.filter(F.contains(F.col(folder), F.lit("-"))).select(folder, F.explode(suffixes).alias("suffix"))
    joined = each.join(ids.select(F.col(key).cast("string").alias(key)).distinct(), F.col("suffix") == F.col(key))
    return joined.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(folder).alias(folder)).filter("n = 1").select(key, folder)
