"""Rows that fail to parse, apart from those that load.

A vectorised scan of the Arrow buffer turns each line into nullable texts and says whether its quoting is sound; the rules
are Catalyst expressions gathered in an error array, by whose emptiness the rows are split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import COMMA, QUOTE, Texts, pieces, strings_from

#: Bytes of text scanned at once.
PIECE_BYTES = 4 << 20


def split_csv(array: pa.Array | pa.ChunkedArray, delimiter: int = COMMA) -> tuple[pa.ListArray, np.ndarray]:
    """Each line's fields, and whether its quoting is well formed.

    A quoted field begins and ends with a double quote at the field's limits, with quotes within doubled; quotes and line
    breaks are allowed nowhere else. The fields of an ill-formed line are those of the quote parity. An empty or null line
    is one empty field.
    """
    t = Texts(array)
    data, row = t.data, t.row
    pos = np.arange(len(data))
    if not len(data):
        one = pa.ListArray.from_arrays(pa.array(np.arange(t.n + 1, dtype=np.int32)), pa.array([""] * t.n, pa.string()))
        return one, np.ones(t.n, bool)
    quote = data == QUOTE
    count = t.since_start(quote)
    inside = (count % 2).astype(bool)
    cut = (data == delimiter) & ~inside
    first = (pos == t.start[row]) | np.concatenate(([False], cut[:-1]))
    last = (pos == t.end[row] - 1) | np.concatenate((cut[1:], [False]))
    before = np.concatenate(([False], quote[:-1])) & ~(pos == t.start[row])
    after = np.concatenate((quote[1:], [False])) & ~(pos == t.end[row] - 1)
    opens = quote & inside
    closes = quote & ~inside
    bad = (opens & ~first & ~before) | (closes & ~last & ~after) | (((data == 10) | (data == 13)) & ~inside)
    sound = (t.per_row(bad) == 0) & (t.per_row(quote) % 2 == 0)
    second = opens & before & ~first
    keep = ~(quote & ~second)
    cuts = pos[cut]
    fields = t.per_row(cut) + 1
    begins = np.sort(np.concatenate((t.start, cuts + 1)), kind="stable")
    ends = np.sort(np.concatenate((t.end, cuts)), kind="stable")
    values = strings_from(data, keep, begins, ends)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(fields))).astype(np.int32)), values), sound


def parse_lines(df: DataFrame, line: str = "line", fields: str = "fields", sound: str = "sound") -> DataFrame:
    """``df`` with ``fields`` array<string> and ``sound`` boolean of the CSV text ``line``; ``line`` stays. Columns with the name
    of an added one, in any case, are left out."""
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in (fields.lower(), sound.lower())])
    schema = T.StructType([*df.schema.fields, T.StructField(fields, T.ArrayType(T.StringType())), T.StructField(sound, T.BooleanType())])
    at = df.columns.index(line)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, [at], PIECE_BYTES):
                values, ok = split_csv(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, values, pa.array(ok)], names=[*batch.schema.names, fields, sound])

    return df.mapInArrow(scan, schema)


def judge(df: DataFrame, rules: Sequence[tuple[str, Column]], errors: str = "errors") -> DataFrame:
    """``df`` with an array of the names of the rules that a row breaks, in the rules' order; a null verdict is no
    breach."""
    verdicts = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules]
    return df.withColumn(errors, F.filter(F.array(*verdicts), lambda x: x.isNotNull()))


def split_rows(df: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(rows without errors, rows with errors and the first as ``reason``)."""
    good = df.filter(F.size(errors) == 0).drop(errors)
    bad = df.filter(F.size(errors) > 0).withColumn("reason", F.element_at(errors, 1))
    return good, bad
