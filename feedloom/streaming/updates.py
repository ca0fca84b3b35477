"""Catalogs kept up to date from streams of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fresh_rows(stream: DataFrame, key: list[str], event_time: str, lateness: str) -> DataFrame:
    """The stream without repeated rows; rows later than ``lateness`` behind the watermark are dropped, as is the state."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(key)


def counts_by_window(stream: DataFrame, event_time: str, lateness: str, width: str, by: list[Column | str]) -> DataFrame:
    """(window_start, by, n) in tumbling windows."""
    windowed = stream.withWatermark(event_time, lateness).groupBy(F.window(event_time, width), *by)
    return windowed.agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")


#: Parts that a patched table is divided into by a hash of its key; a batch rewrites only those that it touches.
BUCKETS = 64


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """The paths of all fields that aren't structs."""
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name)


def _at(path: tuple[str, ...]) -> Column:
    c = F.col(f"`{path[0]}`")
    for name in path[1:]:
        c = c[name]
    return c


def _nested(schema: T.StructType, values: dict[tuple[str, ...], Column], path: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``schema`` put together from those of its leaves; a struct without any value is null."""
    out = []
    for f in schema.fields:
        own = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            held = [values[own + leaf] for leaf in _leaves(f.dataType)]
            out.append(F.when(reduce(lambda a, b: a | b, [c.isNotNull() for c in held], F.lit(False)), F.struct(*_nested(f.dataType, values, own))).alias(f.name))
        else:
            out.append(values[own].alias(f.name))
    return out


def merged_patches(base: DataFrame | None, batch: DataFrame, key: str, order: str, fixed: Sequence[str] = ("data_type",), new_rows: bool = True) -> DataFrame:
    """The rows of ``base`` (as this function gives them) patched by those of ``batch``, with the order of each field's value in
    ``__orders``.

    Of each field, structs by their own fields, the value of the highest ``order`` counts that isn't null, of ``fixed`` ones that
    of the lowest; among equal orders the greatest by its text. So the result depends on the patches alone, not on how they fall
    into batches. One aggregation over both, which starts before the shuffle, so no hot key gathers. Rows without a key are left
    out; without ``new_rows`` those of keys that ``base`` lacks too.
    """
    schema = T.StructType([f for f in batch.schema.fields if f.name not in (key, order)])
    leaves = list(_leaves(schema))
    names = {leaf: f"v{i}" for i, leaf in enumerate(leaves)}
    patches = batch.select(F.col(key).alias("__key"), F.lit(False).alias("__there"), *[_at(leaf).alias(n) for leaf, n in names.items()], *[F.when(_at(leaf).isNotNull(), F.col(order)).alias(f"o_{n}") for leaf, n in names.items()])
    both = patches.filter(F.col("__key").isNotNull())
    if base is not None:
        both = both.unionByName(base.select(F.col(key).alias("__key"), F.lit(True).alias("__there"), *[_at(leaf).alias(n) for leaf, n in names.items()], *[F.col("__orders")[n].alias(f"o_{n}") for n in names.values()]))
    out = [F.max("__there").alias("__there")]
    for leaf, n in names.items():
        rank = F.when(F.col(f"o_{n}").isNotNull(), F.struct(f"o_{n}", F.to_json(F.struct(n))))
        first = leaf[0] in fixed
        out += [(F.min_by if first else F.max_by)(n, rank).alias(n), (F.min if first else F.max)(f"o_{n}").alias(f"o_{n}")]
    rows = both.groupBy("__key").agg(*out)
    if not new_rows:
        rows = rows.filter("__there")
    orders = F.struct(*[F.col(f"o_{n}").alias(n) for n in names.values()])
    return rows.select(F.col("__key").alias(key), *_nested(schema, {leaf: F.col(n) for leaf, n in names.items()}), orders.alias("__orders"))


def apply_patches(stream: DataFrame, table: str, key: str, order: str, checkpoint: str, new_rows: bool = True, buckets: int = BUCKETS):  # noqa: ANN201
    """Starts a query that patches the Parquet folder ``table`` with each micro-batch, as ``merged_patches`` says; read it with
    ``current``.

    A batch rewrites the buckets of its keys into a folder of its own and then writes which folder holds each bucket, so a
    repeated batch writes the same again and readers never see half of one. What neither this version nor the one before needs is
    removed.
    """

    def patch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
        batch.persist()
        touched = [r[0] for r in batch.filter(F.col(key).isNotNull()).select(bucket.alias("b")).distinct().collect()]
        before = _held(spark, table, number)
        base = _read(spark, table, {b: v for b, v in before.items() if b in touched})
        merged = merged_patches(base, batch, key, order, new_rows=new_rows)
        merged.withColumn("__bucket", bucket).repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{table}/data/version={number}")
        batch.unpersist()
        written = {b for b in touched if _exists(spark, f"{table}/data/version={number}/__bucket={b}")}
        now = {b: v for b, v in before.items() if b not in written} | dict.fromkeys(written, number)
        spark.createDataFrame(sorted(now.items()), "bucket int, version long").coalesce(1).write.mode("overwrite").json(f"{table}/done/number={number}")
        _clear(spark, table, number, {*before.items(), *now.items()})

    return stream.writeStream.foreachBatch(patch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _files(spark, path: str):  # noqa: ANN001, ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark, path: str) -> bool:  # noqa: ANN001
    files, p = _files(spark, path)
    return files.exists(p)


def _listed(spark, path: str) -> list[str]:  # noqa: ANN001
    files, p = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(p)] if files.exists(p) else []


def _numbers(spark, table: str) -> list[int]:  # noqa: ANN001
    """The batches that are whole."""
    named = [n for n in _listed(spark, f"{table}/done") if n.startswith("number=")]
    return sorted(int(n.partition("=")[2]) for n in named if _exists(spark, f"{table}/done/{n}/_SUCCESS"))


def _held(spark, table: str, before: int | None = None) -> dict[int, int]:  # noqa: ANN001
    """Which version holds each bucket, of the latest version or the latest before a batch's number."""
    numbers = [n for n in _numbers(spark, table) if before is None or n < before]
    if not numbers:
        return {}
    rows = spark.read.schema("bucket int, version long").json(f"{table}/done/number={numbers[-1]}").collect()
    return {r["bucket"]: r["version"] for r in rows}


def _read(spark, table: str, held: dict[int, int]) -> DataFrame | None:  # noqa: ANN001
    if not held:
        return None
    return spark.read.option("mergeSchema", True).parquet(*[f"{table}/data/version={v}/__bucket={b}" for b, v in sorted(held.items())])


def _clear(spark, table: str, number: int, needed: set[tuple[int, int]]) -> None:  # noqa: ANN001
    files, _ = _files(spark, table)
    for version in _listed(spark, f"{table}/data"):
        v = int(version.partition("=")[2])
        buckets = [b for b in _listed(spark, f"{table}/data/{version}") if b.startswith("__bucket=")]
        old = [b for b in buckets if (int(b.partition("=")[2]), v) not in needed]
        for b in old:
            files.delete(_files(spark, f"{table}/data/{version}/{b}")[1], True)
        if len(old) == len(buckets) and v < number:
            files.delete(_files(spark, f"{table}/data/{version}")[1], True)
    for n in _numbers(spark, table)[:-2]:
        files.delete(_files(spark, f"{table}/done/number={n}")[1], True)


def current(spark, table: str) -> DataFrame | None:  # noqa: ANN001
    """The latest whole version; None if there is none."""
    found = _read(spark, table, _held(spark, table))
    return None if found is None else found.drop("__orders", "__bucket")
