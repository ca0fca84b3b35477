"""Projections: nesting, flattening, lists of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat_columns(schema: T.StructType, prefix: str = "") -> list[Column]:
    """Every leaf of nested structs under its dotted name; arrays stay whole."""
    out: list[Column] = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        if isinstance(f.dataType, T.StructType):
            out += flat_columns(f.dataType, path)
        else:
            out.append(F.col(".".join(f"`{p}`" for p in path.split("."))).alias(path))
    return out


def flatten(df: DataFrame) -> DataFrame:
    return df.select(*flat_columns(df.schema))


def quoted(name: str) -> Column:
    """A column whose name may hold dots."""
    return F.col(f"`{name}`")


def project(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """The columns in this order; a missing one is null text, or an error if ``strict``."""
    there = set(df.columns)
    missing = [c for c in columns if c not in there]
    if strict and missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.select(*[quoted(c) if c in there else F.lit(None).cast("string").alias(c) for c in columns])


def has_columns(df: DataFrame, columns: str | Sequence[str]) -> bool:
    return {columns} <= set(df.columns) if isinstance(columns, str) else set(columns) <= set(df.columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def stamp(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def relative_difference(a: Column, b: Column) -> Column:
    """(a - b) / b; infinite where b is 0."""
    return F.when(b == 0, F.lit(float("inf"))).otherwise(F.try_divide(a - b, b))


def nested_json(row: Column, pretty: bool = False, keep_nulls: bool = False) -> Column:
    """A struct as JSON; null fields are left out unless kept."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return F.to_json(row, options | ({"pretty": "true"} if pretty else {}))


def schedule_struct(c: Mapping[str, Column]) -> Column:
    """The nested form of a schedule row from flat columns."""
    box = F.struct(*[c[n].alias(n) for n in ("minimum_latitude", "maximum_latitude", "minimum_longitude", "maximum_longitude", "extracted_on")])
    place = F.struct(*[c[n].alias(n) for n in ("country_code", "subdivision_name", "municipality")], box.alias("bounding_box"))
    urls = F.struct(*[c[n].alias(n) for n in ("direct_download", "authentication_type", "authentication_info", "api_key_parameter_name", "latest", "license")])
    head = [c[n].alias(n) for n in ("mdb_source_id", "data_type", "provider", "name", "feed_contact_email", "features", "status")]
    return F.struct(*head, place.alias("location"), urls.alias("urls"), F.coalesce(c["redirect"], F.array().cast("array<struct<id:string,comment:string>>")).alias("redirect"), c["is_official"].alias("is_official"), c["is_producer_url_unstable"].alias("is_producer_url_unstable"))


def described(columns: Sequence[str]) -> Column:
    """A readable line for each row."""
    return F.concat_ws("; ", *[F.concat(F.lit(f"{c}: "), F.coalesce(quoted(c).cast("string"), F.lit("-"))) for c in columns])
