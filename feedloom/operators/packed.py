"""Several values packed in one text: one row per value, with its position.

The kernel scans the Arrow value buffer once: quote parity by prefix sums, a mask of separators outside quotes, child offsets
from the mask's edges, then a list array that Spark flattens with its parent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import APOSTROPHE, QUOTE, Texts, pieces, strings_from

#: Bytes that separate values outside quotes: pipe, semicolon, comma, slash, plus, ampersand and white space.
SEPARATORS = b"|;,/+& \t\n\r\x0b\x0c"
#: The unquoted word that separates values too.
SEPARATOR_WORD = b"and"
#: Bytes of text scanned at once.
PIECE_BYTES = 4 << 20
WHITE = b" \t\n\r\x0b\x0c"


def _is_one_of(data: np.ndarray, chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table[data]


def split_packed(array: pa.Array | pa.ChunkedArray, separators: bytes = SEPARATORS, word: bytes | None = SEPARATOR_WORD) -> pa.ListArray:
    """The values of each text, in order.

    Null, empty and blank texts and texts of separators only give an empty list. A double quote opens a quoted value
    anywhere, a single quote only beside a separator or the text's ends (apostrophes stay). Doubled quotes within quotes
    are made single. A quote that is never closed is an ordinary character. One pair of brackets around the whole text is
    dropped. Values are trimmed; empty ones don't count.
    """
    t = Texts(array)
    data, row = t.data, t.row
    if not len(data):
        return pa.ListArray.from_arrays(pa.array(np.zeros(t.n + 1, np.int32)), pa.array([], pa.string()))
    pos = np.arange(len(data))
    white = _is_one_of(data, WHITE)
    # no-break space, U+00A0, is white space of two bytes
    nbsp = (data == 0xC2) & (t.at(pos + 1) == 0xA0) & (pos + 1 < t.end[row])
    white |= nbsp | np.concatenate(([False], nbsp[:-1]))
    # one pair of brackets around the text
    solid = ~white
    first = np.full(t.n, -1)
    last = np.full(t.n, -1)
    np_rows = row[solid]
    first[np_rows[::-1]] = pos[solid][::-1]
    last[np_rows] = pos[solid]
    boxed = (first >= 0) & (last > first) & (t.at(first) == ord("[")) & (t.at(last) == ord("]"))
    bracket = np.zeros(len(data), bool)
    bracket[first[boxed]] = True
    bracket[last[boxed]] = True
    # parity of double quotes; an unpaired last one is ordinary
    dq = data == QUOTE
    odd = (t.per_row(dq) % 2).astype(bool)
    if odd.any():
        last_quote = np.full(t.n, -1)
        last_quote[row[dq]] = pos[dq]
        dq[last_quote[odd]] = False
    inside = (t.since_start(dq) % 2).astype(bool)
    sep = (_is_one_of(data, separators) | white | bracket) & ~inside
    # single quotes at the edge of a value, outside double quotes
    at_start = pos == t.start[row]
    at_end = pos == t.end[row] - 1
    before = np.concatenate(([True], sep[:-1])) | at_start
    after = np.concatenate((sep[1:], [True])) | at_end
    apostrophe = (data == APOSTROPHE) & ~inside
    sq = apostrophe & (before | after)
    # a doubled single quote within
    odd = (t.per_row(sq) % 2).astype(bool)
    if odd.any():
        last_quote = np.full(t.n, -1)
        last_quote[row[sq]] = pos[sq]
        sq[last_quote[odd]] = False
    in_single = (t.since_start(sq) % 2).astype(bool)
    sep &= ~in_single
    value = ~sep
    begin = value & (np.concatenate(([True], sep[:-1])) | at_start)
    finish = value & (np.concatenate((sep[1:], [True])) | at_end)
    start, end = pos[begin], pos[finish] + 1
    # quotes are dropped; the second of a doubled one within quotes stays
    quote = dq | sq
    doubled = dq & inside & np.concatenate(([False], dq[:-1])) & ~at_start
    keep = ~quote | doubled
    # trim what was inside the quotes
    ink = np.concatenate(([0], np.cumsum(keep & ~white)))
    if len(start):
        inked = np.flatnonzero(keep & ~white)
        lo = np.minimum(np.searchsorted(inked, start), max(len(inked) - 1, 0))
        hi = np.searchsorted(inked, end) - 1
        good = ink[end] > ink[start]
        quoted = np.concatenate(([0], np.cumsum(quote)))
        if word is not None:
            is_word = (end - start == len(word)) & (quoted[end] == quoted[start])
            for i, c in enumerate(word):
                is_word &= (t.at(start + i) | 0x20) == c
            good &= ~is_word
        start, end = (inked[lo[good]], inked[hi[good]] + 1) if len(inked) else (start[:0], end[:0])
    items = strings_from(data, keep, start, end)
    sizes = np.bincount(row[start], minlength=t.n) if len(start) else np.zeros(t.n, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), items)


def unpack(df: DataFrame, key: str, fields: dict[str, Column], separators: bytes = SEPARATORS, word: bytes | None = SEPARATOR_WORD, least: int = 2) -> DataFrame:
    """Rows (key, field, pos, item), one for each value.

    ``fields`` gives the packed texts and their names; other columns of ``df`` are dropped. Only fields with at least ``least`` values give rows; ``pos`` counts from 1. Null
    texts give none. The scan runs once over all fields, without a shuffle.
    """
    keys = [key]
    wide = df.select(*keys, *[c.cast("string").alias(f"__{i}") for i, c in enumerate(fields.values())])
    schema = T.StructType([*wide.select(*keys).schema.fields, *[T.StructField(f"__{i}", T.ArrayType(T.StringType())) for i in range(len(fields))]])
    n_keys = len(keys)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, list(range(n_keys, batch.num_columns)), PIECE_BYTES):
                columns = [part.column(i) for i in range(n_keys)]
                columns += [split_packed(part.column(n_keys + i), separators, word) for i in range(part.num_columns - n_keys)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    lists = wide.mapInArrow(scan, schema)
    pairs = F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"__{i}").alias("items")) for i, name in enumerate(fields)])
    each = lists.select(*keys, F.explode(pairs).alias("__f")).filter(F.size("__f.items") >= least)
    return each.select(*keys, F.col("__f.field").alias("field"), F.posexplode("__f.items").alias("__pos", "item")).select(*keys, "field", (F.col("__pos") + 1).cast("int").alias("pos"), "item")
