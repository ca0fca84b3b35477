"""Operations on a whole table's order, without gathering it in one task.

Rows are range-partitioned; what a part needs of the parts before it is a few values a part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partitioned with the part's number, ``__part``. Done before costly maps, so that the ranges are sampled without them;
    ``forward_fill`` then takes the parts as they are."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id())


def _in_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """In parts, and cut, since a second sampling might divide the rows differently."""
    return cut(df if "__part" in df.columns else ranged(df, order))


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """``df`` with the rows' numbers from 1 in the order, which should be total."""
    parts = _in_parts(df, order)
    counts = parts.groupBy("__part").count()
    # one row a part
    before = counts.select("__part", F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    numbered = parts.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return numbered.join(F.broadcast(before), "__part").withColumn(name, F.col("__n") + F.col("__before")).drop("__part", "__n", "__before")


def chunks(df: DataFrame, order: Sequence[str], most: int = 64, name: str = "chunk") -> DataFrame:
    """``df`` in min(most, rows) contiguous chunks from 1, the first rows mod chunks of them one longer; with ``row_no``."""
    numbered = row_numbers(df, order)
    total = numbered.count()
    k = max(1, min(most, total))
    size, longer = divmod(total, k)
    n = F.col("row_no") - 1
    head = longer * (size + 1)
    return numbered.withColumn(name, (F.when(n < head, F.floor(n / (size + 1))).otherwise(longer + F.floor((n - head) / max(size, 1))) + 1).cast("int"))


def forward_fill(df: DataFrame, order: Sequence[str], value: Column, name: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with the last known ``value`` up to each row; null before the first.

    ``by`` fills within groups by a window; without it the whole order is filled part by part, each starting from the last value
    known in the parts before it.
    """
    if by:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.last(value, True).over(w))
    parts = _in_parts(df.withColumn("__v", value), order)
    order_struct = F.struct(*order)
    last = parts.groupBy("__part").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), order_struct)).alias("__last"))
    carried = last.select("__part", F.last("__last", True).over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)).alias("__carried"))
    within = F.last("__v", True).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("__w", within).join(F.broadcast(carried), "__part").withColumn(name, F.coalesce("__w", "__carried")).drop("__part", "__v", "__w", "__carried")


def ordered_join(rows: DataFrame, by: Sequence[str], order: Sequence[Column], text: Column, name: str, separator: str = "") -> DataFrame:
    """(by, name): each group's texts joined in the order. A group must fit a task: chunks and batches do."""
    pairs = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], text.alias("x"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(pairs, lambda p: p["x"]), separator).alias(name))
