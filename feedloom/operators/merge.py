"""Unions with override and patches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def override_union(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """All columns of all parts; of the rows of one key those of the last part count, within it any one.

    The choice is a maximum over structs, so it is pre-aggregated before the shuffle and no hot key gathers in a task. Rows of a
    null key form one key.
    """
    numbered = [p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    others = [c for c in union.columns if c not in (key, "__part")]
    best = union.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), "__part").alias("__row"))
    return best.select(F.col(f"`{key}`"), *[F.col(f"__row.`{c}`").alias(c) for c in others])


def concat(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows under one another, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _patched(base_type: T.DataType, base: Column, patch_type: T.DataType | None, patch: Column) -> Column:
    if patch_type is None:
        return base
    if isinstance(base_type, T.StructType) and isinstance(patch_type, T.StructType):
        inner = {f.name: f.dataType for f in patch_type.fields}
        parts = [_patched(f.dataType, base[f.name], inner.get(f.name), patch[f.name] if f.name in inner else patch).alias(f.name) for f in base_type.fields]
        return F.when(base.isNull() & patch.isNull(), F.lit(None)).otherwise(F.struct(*parts))
    return F.coalesce(patch, base)


def patch_merge(base: DataFrame, patch: DataFrame, key: str, fixed: Sequence[str] = ("data_type",)) -> DataFrame:
    """``base`` with the values of ``patch`` (unique in ``key``) that aren't null; null keeps what was there.

    Structs are patched field by field. ``key`` and ``fixed`` never change; patches of unknown keys do nothing; columns that
    ``base`` lacks are ignored.
    """
    new = {f.name: f.dataType for f in patch.schema.fields}
    side = patch.select(F.col(key).alias("__key"), F.struct("*").alias("__patch"))
    joined = base.join(side, base[key] == F.col("__key"), "left")
    out = []
    for f in base.schema.fields:
        if f.name == key or f.name in fixed or f.name not in new:
            out.append(F.col(f.name))
        else:
            out.append(_patched(f.dataType, F.col(f.name), new[f.name], F.col("__patch")[f.name]).alias(f.name))
    return joined.select(*out)


def next_id(*catalogs: DataFrame, key: str | None = None) -> DataFrame:
    """(next_id): rows of all catalogs plus 1; with ``key`` the largest numeric id plus 1, which no row has."""
    if key is None:
        counts = [c.agg(F.count(F.lit(1)).alias("n")) for c in catalogs]
        return concat(counts).agg((F.sum("n") + 1).alias("next_id"))
    tops = [c.agg(F.max(F.col(key).cast("string").try_cast("bigint")).alias("n")) for c in catalogs]
    return concat(tops).agg((F.coalesce(F.max("n"), F.lit(0)) + 1).alias("next_id"))


def append_entities(base: DataFrame, new: DataFrame, key: str = "mdb_source_id") -> DataFrame:
    """``base`` and the new rows of ids that it lacks, redirects to the text None left out."""
    from ..functions.predicates import usable_redirects

    fresh = new.join(base.select(F.col(key).alias("__k")), new[key] == F.col("__k"), "left_anti")
    if "redirect" in fresh.columns:
        fresh = fresh.withColumn("redirect", usable_redirects(F.col("redirect")))
    return base.unionByName(fresh, allowMissingColumns=True)
