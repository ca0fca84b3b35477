"""Where results go. A folder of part files is the default; single files only where one is asked for."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from urllib.parse import unquote
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shapes import flatten, project


def write_pretty_json(df: DataFrame, folder: str, name: Column, row: Column) -> None:
    """One indented file for each row, named by ``name`` (unique, not null). Non-ASCII letters stay; a file of the same name is
    replaced.

    The tasks write a folder a name through Spark's own writer, so any file system of the cluster will do; then the driver renames
    them, which moves no data.
    """
    spark = df.sparkSession
    staging = f"{folder.rstrip('/')}/.staging-{uuid.uuid4().hex}"
    df.select(name.alias("name"), F.to_json(row, {"pretty": "true"}).alias("value")).write.partitionBy("name").text(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    for held in files.listStatus(path(staging)):
        label = held.getPath().getName()
        if label.startswith("name="):
            target = path(f"{folder.rstrip('/')}/{unquote(label[5:])}")
            part = next(f.getPath() for f in files.listStatus(held.getPath()) if f.getPath().getName().startswith("part-"))
            files.delete(target, False)
            files.rename(part, target)
    files.delete(path(staging), True)


def write_csv(df: DataFrame, folder: str, columns: Sequence[str] | None = None, strict: bool = True, single: bool = False) -> None:
    """Flattened, projected, with a header. ``single`` gathers everything in one file: for exports that one task can write."""
    flat = flatten(df)
    flat = project(flat, columns, strict) if columns is not None else flat
    (flat.coalesce(1) if single else flat).write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """A workbook's sheets as CSV folders side by side, for tables of any size."""
    for name, df in sheets.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


#: Rows that a sheet of a workbook may have.
SHEET_ROWS = 1_048_576
_SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def write_workbook(sheets: dict[str, DataFrame], path: str) -> None:
    """One workbook with a sheet for each table, headers first: for reports that a person reads.

    The rows come to the driver part by part and go straight into the file; a table of more rows than a sheet may have is an error.
    Nulls are empty cells, numbers and booleans stay such, anything else is text.
    """
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with tempfile.TemporaryDirectory() as held:
        local = os.path.join(held, "book.xlsx")
        with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as z:
            numbers = range(1, len(sheets) + 1)
            parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kinds}.worksheet+xml"/>' for i in numbers)
            z.writestr("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>{parts}</Types>')
            z.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="r{i}"/>' for i, n in zip(numbers, sheets, strict=True))
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{_SHEET}" xmlns:r="{_OFFICE}"><sheets>{names}</sheets></workbook>')
            links = "".join(f'<Relationship Id="r{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
            z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
            for i, (name, df) in zip(numbers, sheets.items(), strict=True):
                with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as out:
                    out.write(f'<worksheet xmlns="{_SHEET}"><sheetData>{_cells(df.columns)}'.encode())
                    for n, row in enumerate(df.toLocalIterator(prefetchPartitions=False), 2):
                        if n > SHEET_ROWS:
                            raise ValueError(f"{name} has more rows than a sheet holds; write_sheets takes any number")
                        out.write(_cells(row).encode())
                    out.write(b"</sheetData></worksheet>")
        spark = next(iter(sheets.values())).sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(True, True, spark._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), target)


def _cells(values: Sequence[object]) -> str:
    out = []
    for v in values:
        if v is None:
            out.append("<c/>")
        elif isinstance(v, bool):
            out.append(f'<c t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, int | float):
            out.append(f"<c><v>{v}</v></c>")
        else:
            text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "", str(v))
            out.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
    return f"<row>{''.join(out)}</row>"


def write_log(df: DataFrame, folder: str, line: Column) -> None:
    """Appends one line of text for each row."""
    df.select(line.alias("value")).write.mode("append").text(folder)


def append_block(df: DataFrame, folder: str, names: dict[str, str]) -> None:
    """Appends the columns ``names`` (source: destination) below what is there."""
    df.select(*[F.col(a).alias(b) for a, b in names.items()]).write.mode("append").parquet(folder)


def replace_table(df: DataFrame, folder: str) -> None:
    """The table as Parquet, in place of what was there; ``df`` must not read from it."""
    df.write.mode("overwrite").parquet(folder)
