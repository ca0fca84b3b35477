"""Datasets: zip files of CSV tables.

``GtfsZip`` is a Python data source: ``spark.read.format("gtfs_zip").option("member", "stops.txt").load(folder)`` gives one row
for each line of the member (several parted by ``|``), ``option("what", "manifest")`` the names of all members and ``"errors"`` the
files that can't be read. One task a file, read as a stream of Arrow batches.
"""

from __future__ import annotations

import csv
import glob
import io
import itertools
import os
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Texts that stand for a missing value in CSV members.
MISSING = ("", "NA", "N/A", "n/a", "NaN", "nan", "null", "NULL", "None", "#N/A", "<NA>", "-nan", "-NaN")
ROWS = "dataset_id string, entry_name string, line_no int, cells map<string,string>"
MANIFEST = "dataset_id string, entry_name string"


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


#: Lines of a batch.
LINES_AT_ONCE = 8_192


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options.get("path", "")
        self.members = [m for m in options.get("member", "").split("|") if m]
        self.what = options.get("what", "rows")

    def partitions(self) -> list[InputPartition]:
        folder = self.folder.removeprefix("file://")
        files = [folder] if os.path.isfile(folder) else sorted(glob.glob(os.path.join(folder, "**", "*.zip"), recursive=True))
        return [_File(p) for p in files] or [_File("")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return
        dataset = os.path.basename(partition.value).removesuffix(".zip")
        try:
            with zipfile.ZipFile(partition.value) as archive:
                if self.what == "manifest":
                    names = archive.namelist()
                    yield _batch([dataset] * len(names), names)
                elif self.what == "rows":
                    held = set(archive.namelist())
                    for member in self.members:
                        if member in held:
                            yield from self._lines(archive, dataset, member)
        except (zipfile.BadZipFile, OSError) as e:
            if self.what == "errors":
                yield _batch([dataset], [f"isn't a readable dataset: {e}"])

    @staticmethod
    def _lines(archive: zipfile.ZipFile, dataset: str, member: str) -> Iterator[pa.RecordBatch]:
        with archive.open(member) as raw:
            lines = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline=""))
            # of a repeated name the last column counts
            header = [h.strip() for h in next(lines, [])]
            kept = sorted({h: i for i, h in enumerate(header)}.values())
            names = [header[i] for i in kept]
            yield _rows(dataset, member, [0], [[None] * len(kept)], names)
            number = 0
            while rows := list(itertools.islice(lines, LINES_AT_ONCE)):
                cells = [[row[i] if i < len(row) else None for i in kept] for row in rows]
                yield _rows(dataset, member, range(number + 1, number + len(rows) + 1), cells, names)
                number += len(rows)


def _batch(datasets: list[str], second: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(datasets, pa.string()), pa.array(second, pa.string())], names=["dataset_id", "entry_name"])


def _rows(dataset: str, member: str, numbers: Sequence[int], cells: list[list[str | None]], names: list[str]) -> pa.RecordBatch:
    n, width = len(cells), len(names)
    values = pa.array(itertools.chain.from_iterable(cells), pa.string())
    values = pc.if_else(pc.is_in(values, pa.array(MISSING)), pa.scalar(None, pa.string()), values)
    maps = pa.MapArray.from_arrays(pa.array(range(0, n * width + 1, width) if width else [0] * (n + 1), pa.int32()), pa.array(names * n, pa.string()), values)
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(dataset), n), pa.repeat(pa.scalar(member), n), pa.array(numbers, pa.int32()), maps], names=["dataset_id", "entry_name", "line_no", "cells"])


class GtfsZip(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gtfs_zip"

    def schema(self) -> str:
        return ROWS if self.options.get("what", "rows") == "rows" else MANIFEST

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GtfsZip)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset_id, entry_name) of the datasets that can be read."""
    register(spark)
    return spark.read.format("gtfs_zip").option("what", "manifest").load(folder)


def read_errors(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset_id, error) of the datasets that can't be read; they are missing from everything else."""
    register(spark)
    return spark.read.format("gtfs_zip").option("what", "errors").load(folder).withColumnRenamed("entry_name", "error")


def read_members(spark: SparkSession, folder: str, members: Sequence[str]) -> DataFrame:
    """(dataset_id, entry_name, line_no, cells) of several members of every dataset, each zip opened once."""
    register(spark)
    return spark.read.format("gtfs_zip").option("member", "|".join(members)).load(folder)


def member_of(rows: DataFrame, member: str, columns: dict[str, str]) -> DataFrame:
    """One member of ``read_members`` as ``read_member`` gives it."""
    typed = [F.try_element_at("cells", F.lit(c)).try_cast(t).alias(c) for c, t in columns.items()]
    return rows.filter(F.col("entry_name") == member).select("dataset_id", "line_no", F.map_keys("cells").alias("header"), *typed)


def read_member(spark: SparkSession, folder: str, member: str, columns: dict[str, str]) -> DataFrame:
    """A member of every dataset as columns of the given types (null where the text doesn't cast), with ``dataset_id``,
    ``line_no`` and ``header`` (array of the names that the file has; line 0 is the header itself, all values null)."""
    return member_of(read_members(spark, folder, [member]), member, columns)


def data_rows(member: DataFrame) -> DataFrame:
    """Without the header lines."""
    return member.filter("line_no > 0")


def with_columns(member: DataFrame, columns: list[str]) -> DataFrame:
    """(dataset_id, has_columns) of each dataset that has the member at all."""
    wanted = F.array(*[F.lit(c) for c in columns])
    return member.filter("line_no = 0").select("dataset_id", (F.size(F.array_except(wanted, "header")) == 0).alias("has_columns"))


def members_there(datasets: DataFrame, manifest: DataFrame, name: str, flag: str) -> DataFrame:
    """``datasets`` (dataset_id) with whether each holds the member."""
    having = manifest.filter(F.col("entry_name") == name).select("dataset_id").distinct().withColumn(flag, F.lit(True))
    return datasets.join(having, "dataset_id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def sub_directories(manifest: DataFrame) -> DataFrame:
    """(dataset_id, folders) of the datasets with folders among their members."""
    return manifest.filter(F.col("entry_name").endswith("/")).groupBy("dataset_id").agg(F.array_join(F.array_sort(F.collect_list("entry_name")), ", ").alias("folders"))
