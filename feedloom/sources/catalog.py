"""Catalog files: one JSON object a file, read with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name, id_order
from ..operators.merge import override_union
from ..schema import REALTIME, REALTIME_RAW_ONLY, SCHEDULE
from ..session import cut


def read_json_files(spark: SparkSession, path: str, schema: T.StructType, recursive: bool = True, strict: bool = False) -> DataFrame:
    """The objects of a folder's files with ``file_path`` and ``file_name`` (decoded). ``strict`` fails on a malformed file;
    otherwise its fields are null. Of a repeated key the last value holds."""
    reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", recursive).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    df = reader.json(path).select("*", F.col("_metadata.file_path").alias("file_path"), F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file_name"))
    return df


def last_of_each(df: DataFrame, key: str, order: Column | str) -> DataFrame:
    """One row for each key, the last by ``order`` (of equal ones any); rows of a null key are dropped.

    A maximum over structs, so it is pre-aggregated before the shuffle and no hot key gathers in a task.
    """
    others = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.struct(order)).alias("__row")
    best = df.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`")).agg(last)
    return best.select(*[F.col(f"`{c}`") if c == key else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def read_catalog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder as a catalog: of several files with one id the last by path counts."""
    return last_of_each(read_json_files(spark, path, schema), "mdb_source_id", "file_path").drop("file_path")


def read_schedule(spark: SparkSession, path: str) -> DataFrame:
    return read_catalog(spark, path, SCHEDULE)


def read_realtime(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """``raw`` keeps the keys that the normalized form drops."""
    df = read_catalog(spark, path, REALTIME)
    return df if raw else df.drop(*REALTIME_RAW_ONLY)


def read_all(spark: SparkSession, schedule_path: str | None, realtime_path: str | None) -> DataFrame:
    """Both catalogs as exported: raw, realtime rows overriding schedule rows of the same id."""
    parts = []
    if schedule_path:
        parts.append(read_catalog(spark, schedule_path, SCHEDULE).drop("file_name"))
    if realtime_path:
        parts.append(read_realtime(spark, realtime_path, raw=True).drop("file_name"))
    return override_union(parts, "mdb_source_id")


def read_entity(spark: SparkSession, file: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(file)


def with_base_name(df: DataFrame) -> DataFrame:
    return df.withColumn("base", base_name(F.col("file_name")))


def readable(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows that have all of the required fields."""
    good = F.lit(True)
    for c in required:
        good = good & F.col(c).isNotNull()
    return df.filter(good)


def read_csv_lines(spark: SparkSession, path: str, columns: list[str], naive: bool = False) -> DataFrame:
    """Rows of CSV texts with ``file_name`` and ``row_no``, from 1 within each file. ``naive`` splits at every comma, quotes or not,
    and fails on a row of too few columns."""
    if not naive:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return numbered_lines(spark.read.schema(schema).option("multiLine", True).option("escape", '"').csv(path))
    lines = numbered_lines(spark.read.text(path))
    return lines.select("file_name", "row_no", naive_cells(F.col("value"), len(columns)).alias("c")).select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(columns)], "file_name", "row_no")


def naive_cells(line: Column, width: int) -> Column:
    """Split at every comma; an error for fewer cells than ``width``."""
    cells = F.split(line, ",")
    return F.when(F.size(cells) >= width, cells).otherwise(F.raise_error(F.concat(F.lit("too few columns: "), F.size(cells).cast("string"))))


def numbered_lines(rows: DataFrame) -> DataFrame:
    """``rows`` as read from files, with ``file_name`` and ``row_no``.

    The rows are numbered within each block that a task read, behind the rows of the file's blocks before it; only the blocks'
    counts, one row each, meet in the order of the file.
    """
    placed = cut(rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at")))
    counts = placed.groupBy("__file", "__block").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = counts.select(F.col("__file").alias("__f"), F.col("__block").alias("__b"), before.alias("__before"))
    within = placed.withColumn("__n", F.row_number().over(Window.partitionBy("__file", "__block").orderBy("__at")))
    joined = within.join(before, (F.col("__file") == F.col("__f")) & (F.col("__block") == F.col("__b")))
    return joined.select(*rows.columns, F.url_decode(F.replace(F.element_at(F.split("__file", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("file_name"), (F.col("__n") + F.col("__before")).alias("row_no"))


def row_range(df: DataFrame, spec: str, number: str = "row_no") -> DataFrame:
    """Rows ``"5"`` or ``"3:10"``, both ends included."""
    first, _, last = spec.partition(":")
    try:
        low, high = int(first), int(last or first)
    except ValueError:
        raise ValueError(f"not a row or a range of rows: {spec!r}") from None
    return df.filter(F.col(number).between(low, high))


def ordered(df: DataFrame, key: str = "mdb_source_id") -> DataFrame:
    return df.orderBy(*id_order(F.col(key)))
