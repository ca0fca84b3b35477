"""Passages of held-out items in documents.

Template canonicalisation: each word is replaced by its slot type if it is a number, a unit or a name, so that windows of words
become templates. Windows are hashed by a rolling polynomial over whole Arrow batches and joined by their template; the slots
are then compared by their hash: equal slots are verbatim leaks, slots that differ by a consistent renaming are re-parameterised items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import hot_keys, salted_lookup
from ..session import cut

#: Words of a window.
WINDOW = 12
#: Most bytes of a filter that is shipped to every task; one of more hashes lets more windows through to the join, which is exact.
BLOOM_BYTES = 64 << 20
#: Rows of windows of held-out items up to which they are broadcast (some 50 bytes each).
BROADCAST_WINDOWS = 50_000
#: Words for units of measurement, money and time.
UNITS = frozenset("second seconds minute minutes hour hours day days week weeks month months year years metre metres meter meters kilometre kilometres kilometer kilometers km m mile miles percent euro euros dollar dollars pound pounds litre litres kilogram kilograms kg tonne tonnes degree degrees".split())
_WORDS = re.compile(r"[^\W_]+")
_NUMBER, _UNIT, _NAME = 1, 2, 3
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORDS.findall(text.lower()) if text else []


class Bloom:
    """A set of 64-bit hashes that says yes to each of its own and to few others."""

    PROBES = 4

    def __init__(self, bits: np.ndarray):
        """``bits``: bytes, their number a power of two."""
        self.bits = bits
        self.mask = np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def size(n: int) -> int:
        """Bytes for ``n`` hashes: 16 to 32 bits each, within ``BLOOM_BYTES``."""
        return min(BLOOM_BYTES, 1 << max(10, (2 * max(n, 1) - 1).bit_length()))

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        h = hashes.view(np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.PROBES):
                yield (h * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x51ED2701) >> np.uint64(17)) & self.mask

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self._places(hashes):
            out &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def bloom(hashes: DataFrame, n: int) -> Bloom:
    """Of one column of 64-bit hashes. Each of a few tasks fills bits of its own; the driver takes them one after another."""
    size = Bloom.size(n)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bloom(np.zeros(size, np.uint8))
        for batch in batches:
            own.add(batch.column(0).to_numpy().astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([own.bits.tobytes()], pa.binary())], names=["bits"])

    whole = np.zeros(size, np.uint8)
    for row in hashes.coalesce(8).mapInArrow(fill, "bits binary").toLocalIterator():
        whole |= np.frombuffer(row["bits"], np.uint8)
    return Bloom(whole)


class Templates:
    def __init__(self, known: Bloom):
        """``known``: the hashes of words that aren't names; a name that it holds by chance is one word of the template, on both
        sides alike."""
        self.known = known
        self.cache: dict[str, tuple[int, int]] = {}

    def codes(self, word: str) -> tuple[int, int]:
        """(hash of the word's template form, hash of the word if it fills a slot, else 0)."""
        got = self.cache.get(word)
        if got is None:
            own = xxhash.xxh3_64_intdigest(word) | 1
            if word.isdigit():
                got = (_NUMBER, own)
            elif word in UNITS:
                got = (_UNIT, own)
            else:
                got = (own, 0) if self.known.may_hold(np.array([own], np.uint64))[0] else (_NAME, own)
            if len(self.cache) > 1_000_000:
                self.cache.clear()
            self.cache[word] = got
        return got

    def windows(self, texts: list[str | None], width: int = WINDOW, wanted: Bloom | None = None) -> tuple[np.ndarray, ...]:
        """(text of each window, its first word, template hash, pattern hash, slot hash); only templates that ``wanted`` may hold.

        The pattern hash says which slots are equal to each other, the slot hash what they hold.
        """
        split = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        codes = np.array([self.codes(w) for ws in split for w in ws], np.uint64).reshape(-1, 2)
        n = len(codes)
        none = np.zeros(0, np.int64)
        if n < width:
            return none, none, none, none, none
        owner = np.repeat(np.arange(len(split)), sizes)
        first = np.arange(n - width + 1)
        first = first[owner[first] == owner[first + width - 1]]
        with np.errstate(over="ignore"):
            template = np.zeros(len(first), np.uint64)
            for k in range(width):
                template = template * _PRIME + codes[first + k, 0]
        template = template.view(np.int64)
        if wanted is not None:
            hit = wanted.may_hold(template)
            first, template = first[hit], template[hit]
        slots = np.zeros(len(first), np.uint64)
        pattern = np.zeros(len(first), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width):
                own = codes[first + k, 1]
                slots = slots * _PRIME + own
                # the place of the first equal slot in the window
                same = np.full(len(first), k, np.uint64)
                for j in range(k - 1, -1, -1):
                    same = np.where(codes[first + j, 1] == own, np.uint64(j), same)
                pattern = pattern * _PRIME + np.where(own == 0, np.uint64(99), same)
        starts = np.cumsum(sizes) - sizes
        return owner[first], first - starts[owner[first]], template, pattern.view(np.int64), slots.view(np.int64)


def window_table(df: DataFrame, key: str, text: str, known: Bloom, wanted: Bloom | None = None, width: int = WINDOW) -> DataFrame:
    """(key, template, pattern, slots): the windows of each text; a window that repeats within a batch's text is given once."""
    schema = T.StructType([df.schema[key], *[T.StructField(n, T.LongType(), False) for n in ("template", "pattern", "slots")]])
    # filters of at most BLOOM_BYTES
    shipped = df.sparkSession.sparkContext.broadcast((known, wanted))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hashes = shipped.value
        made = Templates(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                row, _, template, pattern, slots = made.windows(part.column(1).to_pylist(), width, hashes)
                _, once = np.unique(np.stack([row, template, pattern, slots], axis=1), axis=0, return_index=True) if len(row) else (None, row)
                row, template, pattern, slots = (v[once] for v in (row, template, pattern, slots))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(template), pa.array(pattern), pa.array(slots)], names=[key, "template", "pattern", "slots"])

    return df.select(key, text).mapInArrow(scan, schema)


def _sides(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, width: int) -> tuple[DataFrame, DataFrame]:
    """The windows of the documents that may be templates of items, and the items' windows, cut."""
    texts = items.select(F.col(item_text).alias("t")).filter("t IS NOT NULL")
    # words that occur in lower case, without digits, aren't names
    words = texts.select(F.explode(F.regexp_extract_all("t", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("w")).filter(F.col("w") == F.lower("w")).distinct()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [xxhash.xxh3_64_intdigest(w) | 1 for w in batch.column(0).to_pylist() if w.isalpha() and w not in UNITS]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(kept, np.uint64).view(np.int64))], names=["h"])

    hashes = cut(words.mapInArrow(hashed, "h bigint"))
    known = bloom(hashes, hashes.count())
    held = cut(window_table(items, item_id, item_text, known, None, width))
    wanted = bloom(held.select("template"), held.count())
    return window_table(documents, doc_id, text, known, wanted, width), held


def _matched(found: DataFrame, held: DataFrame, columns: tuple[str, ...], how: str = "inner") -> DataFrame:
    """``found`` joined with ``held`` (its columns named h_...) where ``columns`` are equal: a broadcast of few held rows, else a
    shuffle in which passages of many documents are salted."""
    if held.count() <= BROADCAST_WINDOWS:
        same = [found[c] == held[f"h_{c}"] for c in columns]
        return found.join(F.broadcast(held), same, how)
    found = cut(found.withColumn("__k", F.to_json(F.struct(*columns))).withColumn("__by", F.monotonically_increasing_id()))
    held = held.withColumn("__h", F.to_json(F.struct(*[F.col(f"h_{c}").alias(c) for c in columns])))
    return salted_lookup(found, held, "__k", "__h", "__by", hot_keys(found, "__k", found.count()), how).drop("__k", "__by", "__h")


def leaked(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, width: int = WINDOW) -> DataFrame:
    """(doc id, item id): documents that hold at least ``width`` consecutive words of the item.

    Words are runs of letters and digits compared without case. Texts of fewer words, null and empty ones hold nothing; copies
    of documents and items each give their rows.
    """
    found, held = _sides(documents, doc_id, text, items, item_id, item_text, width)
    held = held.select(F.col(item_id).alias("__item"), *[F.col(c).alias(f"h_{c}") for c in ("template", "pattern", "slots")]).distinct()
    return _matched(found, held, ("template", "pattern", "slots")).select(doc_id, F.col("__item").alias(item_id)).distinct()


def reparameterised(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, width: int = WINDOW) -> DataFrame:
    """(doc id, windows, item id): documents with windows of an item whose slots are renamed consistently, and how many; a row for
    each item that has any of them. Windows that are verbatim those of any item count for none."""
    found, held = _sides(documents, doc_id, text, items, item_id, item_text, width)
    forms = held.select(F.col("template").alias("h_template"), F.col("pattern").alias("h_pattern"), F.col(item_id).alias("__item")).distinct()
    exact = held.select(*[F.col(c).alias(f"h_{c}") for c in ("template", "pattern", "slots")]).distinct()
    renamed = _matched(found, exact, ("template", "pattern", "slots"), "left_anti")
    hits = _matched(renamed, forms, ("template", "pattern"))
    return hits.groupBy(doc_id, F.col("__item").alias(item_id)).agg(F.count(F.lit(1)).alias("windows")).select(doc_id, "windows", item_id)
