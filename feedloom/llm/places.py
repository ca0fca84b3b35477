"""Freely typed places mapped to a reference list.

A trie of the reference entries with their alias paths (abbreviated leading words, generic words before a name, the larger unit
after it) is walked together with a Levenshtein automaton of the typed text, simulated bit-parallel: one integer per number of
edits, one step per trie edge. All entries within the distance that the text's length allows come out; the other typed fields
decide between them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.skew import hot_keys, salted_lookup
from ..session import cut
from .fold import fold, osa

#: How leading words of names are abbreviated.
LEADING_WORDS = {"north": ("n", "no", "nth"), "south": ("s", "so", "sth"), "east": ("e",), "west": ("w",), "upper": ("upr", "up"), "lower": ("lwr", "lr"), "saint": ("st",), "mount": ("mt", "mnt"), "port": ("pt",), "fort": ("ft",), "new": ("nw",)}
#: Words that may stand before a name.
GENERIC_WORDS = ("town of", "city of", "municipality of", "village of", "borough of", "commune of", "county of", "greater", "the")
#: The last words that units of the second level may lack.
UNIT_WORDS = ("district", "county", "state", "province", "region", "department", "prefecture", "canton", "oblast", "territory")
#: Entries of a reference block (a trie of some 200 MB). A list of one block is indexed by every task; a larger one is divided over
#: tasks, and the typed values meet each block there.
BLOCK_ENTRIES = 20_000
#: What no entry costs.
NO_ENTRY = 99.0


def allowed(length: int) -> int:
    """Edits allowed for a text of so many characters."""
    return 0 if length <= 3 else 1 if length <= 5 else 2 if length <= 7 else 3


class Trie:
    """Nodes are [edges, ends, jumps]: ends lists what a path to here stands for; jumps are nodes that go on from here without
    a character (alias paths)."""

    def __init__(self) -> None:
        self.root: list = [{}, [], []]

    def path(self, text: str, start: list | None = None) -> list:
        node = self.root if start is None else start
        for c in text:
            node = node[0].setdefault(c, [{}, [], []])
        return node

    def add(self, text: str, value: object) -> None:
        ends = self.path(text)[1]
        if value not in ends:
            ends.append(value)

    def search(self, text: str, most: int) -> dict[object, int]:
        """Everything that a path within ``most`` edits of ``text`` stands for, with its least number of edits."""
        m = len(text)
        full = (1 << (m + 1)) - 1
        accept = 1 << m
        masks: dict[str, int] = {}
        for i, c in enumerate(text):
            masks[c] = masks.get(c, 0) | (1 << i)
        found: dict[object, int] = {}
        start = tuple((1 << (e + 1)) - 1 & full for e in range(most + 1))
        stack = [(self.root, start, None, 0)]
        seen: set[tuple[int, tuple[int, ...]]] = set()
        while stack:
            node, states, earlier, last_mask = stack.pop()
            if node[1] and states[most] & accept:
                edits = next(e for e in range(most + 1) if states[e] & accept)
                for value in node[1]:
                    if edits < found.get(value, most + 1):
                        found[value] = edits
            for jump in node[2]:
                if (id(jump), states) not in seen:
                    seen.add((id(jump), states))
                    stack.append((jump, states, earlier, last_mask))
            for c, child in node[0].items():
                mask = masks.get(c, 0)
                below = (states[0] & mask) << 1
                new = [below]
                for e in range(1, most + 1):
                    less = states[e - 1]
                    below = ((states[e] & mask) << 1) | less | (less << 1) | (below << 1)
                    if earlier is not None:
                        below |= (earlier[e - 1] & mask & (last_mask >> 1)) << 2
                    below &= full
                    new.append(below)
                if new[most]:
                    stack.append((child, tuple(new), states, mask))
        return found


Entry = tuple[int, str, str, str, str]


def unit_forms(unit: str) -> list[str]:
    text = fold(unit)
    body, _, last = text.rpartition(" ")
    return [text, body] if body and last in UNIT_WORDS else [text]


def name_forms(name: str) -> list[str]:
    text = fold(name)
    head, _, tail = text.partition(" ")
    return [text, *[f"{short} {tail}" for short in LEADING_WORDS.get(head, ()) if tail]]


class Areas:
    """The countries and larger units of a list, or of a block of it. entries: (place_id, country_code, country_name,
    subdivision_name, municipality)."""

    def __init__(self, entries: Iterable[Entry]):
        self.trie, self.countries = Trie(), Trie()
        self.codes: dict[str, str] = {}
        for _, code, country, unit, _ in entries:
            for form in unit_forms(unit):
                self.trie.add(form, unit)
            self.codes[fold(code)] = code
            self.countries.add(fold(country), code)
        self.country, self.units = lru_cache(100_000)(self._country), lru_cache(100_000)(self._units)

    def _country(self, typed: str) -> tuple[int, str] | None:
        """(edits, code) of the country meant by a folded text; -1 for a code."""
        if not typed:
            return None
        if typed in self.codes:
            return -1, self.codes[typed]
        found = self.countries.search(typed, min(2, allowed(len(typed))))
        return min((e, c) for c, e in found.items()) if found else None

    def _units(self, typed: str) -> frozenset[str]:
        """The units that a folded text may mean."""
        return frozenset(self.trie.search(typed, min(2, allowed(len(typed))))) if typed else frozenset()


class Names:
    """The entries of a list, or of a block of it, by their names. What an entry costs depends on the typed values and the entry
    alone, not on its block."""

    def __init__(self, entries: Iterable[Entry]):
        self.entries = {e[0]: e for e in entries}
        self.trie = Trie()
        for place, _, _, unit, name in self.entries.values():
            for form in name_forms(name):
                self.trie.add(form, place)
                for tail in unit_forms(unit):
                    self.trie.add(f"{form} {tail}", place)
        # generic words lead back to the beginning, any number of them
        for words in GENERIC_WORDS:
            self.trie.path(words + " ")[2].append(self.trie.root)
        self.named = lru_cache(100_000)(self.trie.search)

    def candidates(self, code: str | None, unit: str, name: str, units: frozenset[str], name_units: frozenset[str]) -> list[tuple[float, int]]:
        """(penalty, place_id) of all entries within the distance, the best first. The penalty is the edits, less for agreeing and
        more for disagreeing fields. ``unit`` and ``name`` are folded, ``units`` and ``name_units`` what they mean as units."""
        readings = self._readings(unit, name, units, name_units)
        return self._within(max(allowed(len(typed)) for typed, _, _ in readings), code, readings)

    def best(self, code: str | None, unit: str, name: str, units: frozenset[str], name_units: frozenset[str]) -> tuple[float, int, int]:
        """(least penalty, how many entries have it, the least place_id of these).

        Edits are allowed one by one, up to what the text's length allows, until no entry with more of them could do better; so all
        entries that are best are among the ones found.
        """
        readings = self._readings(unit, name, units, name_units)
        most = max(allowed(len(typed)) for typed, _, _ in readings)
        found: list[tuple[float, int]] = []
        for edits in range(min(1, most), most + 1):
            found = self._within(edits, code, readings)
            if found and found[0][0] < edits + 1 - 0.75:
                break
        if not found:
            return NO_ENTRY, 0, 0
        return found[0][0], sum(p == found[0][0] for p, _ in found), found[0][1]

    @staticmethod
    def _readings(unit: str, name: str, units: frozenset[str], name_units: frozenset[str]) -> list[tuple[str, frozenset[str], bool]]:
        # the other reading: both typed into the other's field
        return [(name, units, False), *([(unit, name_units, True)] if unit and name_units else [])]

    def _within(self, limit: int, code: str | None, readings: list[tuple[str, frozenset[str], bool]]) -> list[tuple[float, int]]:
        out: dict[int, float] = {}
        for typed, units, swapped in readings:
            most = allowed(len(typed))
            for place, edits in self.named(typed, min(limit, most)).items():
                _, e_code, _, e_unit, _ = self.entries[place]
                agrees = e_unit in units
                if swapped and not agrees:
                    continue
                penalty = edits - 0.5 * agrees - 0.25 * (code == e_code)
                penalty += 2 * (bool(units) and not agrees) + 2 * (code is not None and code != e_code)
                # the last edit of the longest texts is allowed only where the larger unit agrees
                if penalty <= max(most, 1) and (edits < 3 or agrees or self._ends_with(typed, e_unit)):
                    out[place] = min(out.get(place, NO_ENTRY), penalty)
        return sorted((p, place) for place, p in out.items())

    @staticmethod
    def _ends_with(typed: str, unit: str) -> bool:
        """Whether the last words name the unit, but for one edit."""
        words = typed.split()
        return any(osa(" ".join(words[k:]), form, 1) <= 1 for form in unit_forms(unit) for k in range(1, len(words)))


class PlaceIndex:
    """A whole list in one index."""

    def __init__(self, entries: Iterable[Entry]):
        entries = list(entries)
        self.areas, self.names = Areas(entries), Names(entries)
        self.exact = {(c, s, m) for _, c, _, s, m in entries}
        self.best = lru_cache(500_000)(self._best)

    def _typed(self, country: str | None, unit: str | None, name: str | None) -> tuple:
        meant = self.areas.country(fold(country))
        return meant[1] if meant else None, fold(unit), fold(name), self.areas.units(fold(unit)), self.areas.units(fold(name))

    def candidates(self, country: str | None, unit: str | None, name: str | None) -> list[tuple[float, int]]:
        """(penalty, place_id) of all entries within the distance, the best first."""
        return self.names.candidates(*self._typed(country, unit, name)) if fold(name) else []

    def _best(self, country: str | None, unit: str | None, name: str | None) -> int:
        """The place_id of the entry meant; 0 if there is none or several are equally good."""
        if not fold(name):
            return 0
        _, ties, place = self.names.best(*self._typed(country, unit, name))
        return place if ties == 1 else 0


_NAMES = ("place_id", "country_code", "country_name", "subdivision_name", "municipality")


def _typed_rows(df: DataFrame, row_id: str, country: str, unit: str, name: str) -> DataFrame:
    rows = df.select(F.col(row_id).alias("__row"), F.expr(country).cast("string").alias("c"), F.expr(unit).cast("string").alias("u"), F.expr(name).cast("string").alias("n"))
    return rows.filter(F.col("n").isNotNull() & F.col("n").rlike(r"[^\s\p{Z}]"))


def _in_blocks(queries: DataFrame, entries: DataFrame, blocks: int, build: Callable, answer: Callable, schema: str) -> DataFrame:
    """What ``answer(build(block's entries), queries)`` gives for every query and every block.

    ``queries`` has a column ``q``. Each task streams its share of the queries past its block; the entries are sorted before them.
    The blocks hold about ``BLOCK_ENTRIES`` entries each, by a hash of their ids.
    """
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = max(1, parts // blocks)
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    listed = entries.select(F.pmod(F.xxhash64("place_id"), F.lit(blocks)).alias("block"), F.explode(numbers(shares)).alias("share"), F.struct(*_NAMES).alias("entry"))
    asked = queries.select(F.explode(numbers(blocks)).alias("block"), F.pmod(F.xxhash64(F.to_json("q")), F.lit(shares)).alias("share"), "q")
    both = listed.unionByName(asked, allowMissingColumns=True).repartition(blocks * shares, "block", "share").sortWithinPartitions("block", "share", F.col("entry").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if (row["block"], row["share"]) != at:
                    at, held, index = (row["block"], row["share"]), [], None
                if row["entry"] is not None:
                    held.append(tuple(row["entry"][c] for c in _NAMES))
                    continue
                if index is None:
                    index = build(held)
                out += answer(index, row["q"])
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=types)

    declared = T.StructType.fromDDL(schema)
    types, names = to_arrow_schema(declared), declared.names
    return both.mapInArrow(run, declared)


def _resolved(triples: DataFrame, entries: DataFrame, blocks: int) -> DataFrame:
    """(q: key, code, unit, name, units, name_units) of distinct typed triples, against the countries and units of all blocks."""

    def folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], **{k: [fold(x if isinstance(x, str) else None) for x in b[v]] for k, v in (("country", "c"), ("unit", "u"), ("name", "n"))}})

    typed = cut(triples.mapInPandas(folded, "key string, country string, unit string, name string").filter("name <> ''"))
    countries = typed.filter("country <> ''").select(F.struct(F.col("country").alias("text")).alias("q")).distinct()
    units = typed.select(F.explode(F.array("unit", "name")).alias("text")).filter("text <> ''").distinct().select(F.struct("text").alias("q"))
    meant = _in_blocks(countries, entries, blocks, Areas, lambda index, q: [(q["text"], *m)] if (m := index.country(q["text"])) else [], "text string, edits int, code string")
    meant = meant.groupBy("text").agg(F.min(F.struct("edits", "code")).getField("code").alias("code"))
    known = _in_blocks(units, entries, blocks, Areas, lambda index, q: [(q["text"], u) for u in sorted(index.units(q["text"]))], "text string, unit string")
    # the units within two edits of a text
    known = cut(known.groupBy("text").agg(F.array_sort(F.collect_set("unit")).alias("units")))
    out = typed.join(meant.withColumnRenamed("text", "country"), "country", "left").join(known.withColumnRenamed("text", "unit"), "unit", "left")
    out = out.join(known.select(F.col("text").alias("name"), F.col("units").alias("name_units")), "name", "left")
    return cut(out.select(F.struct("key", "code", "unit", "name", F.coalesce("units", F.array()).alias("units"), F.coalesce("name_units", F.array()).alias("name_units")).alias("q")))


def _asked(q: dict) -> tuple:
    return q["code"], q["unit"], q["name"], frozenset(q["units"]), frozenset(q["name_units"])


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", F.to_json(F.struct("c", "u", "n")))


def _with_answers(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Each row with the answers of its values; values of many rows are salted."""
    rows = rows.withColumn("spread", F.monotonically_increasing_id())
    return salted_lookup(rows, answers.withColumnRenamed("key", "answered"), "key", "answered", "spread", hot_keys(rows, "key", rows.count()), "inner")


def _entries(places: DataFrame, block_entries: int) -> tuple[DataFrame, int]:
    entries = places.select(F.col("place_id").cast("long").alias("place_id"), *_NAMES[1:]).na.drop()
    return entries, max(1, -(-entries.count() // block_entries))


def match_places(df: DataFrame, row_id: str, country: str, unit: str, name: str, places: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(row id, place_id): for each row whose name isn't null or blank and whose three values aren't together exactly an
    entry, the entry meant or 0 if there is none or several are equally good.

    ``country``, ``unit`` and ``name`` are column expressions as SQL text. A reference list of at most ``block_entries`` rows is
    indexed by every task, without a shuffle. Of a longer list each block gives its least penalty, how many of its entries have it
    and which; the blocks' answers are combined, so any size of block gives the same. An empty list answers 0. Entries with a null
    are left out of the list; repeated rows of ``df``, with the same id or not, each get their answer.
    """
    rows = _typed_rows(df, row_id, country, unit, name)
    entries, blocks = _entries(places, block_entries)
    if blocks == 1:
        # at most block_entries rows
        listed = df.sparkSession.sparkContext.broadcast([tuple(r) for r in entries.collect()])

        def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = PlaceIndex(listed.value)
            for batch in batches:
                clean = batch.astype(object).where(batch.notna(), None)
                got = [None if (c, u, n) in index.exact else index.best(c, u, n) for c, u, n in zip(clean["c"], clean["u"], clean["n"], strict=True)]
                batch["place_id"] = pd.array(got, dtype="Int64")
                yield batch[["__row", "place_id"]][batch["place_id"].notna()]

        found = rows.mapInPandas(answer, f"__row {rows.schema['__row'].dataType.simpleString()}, place_id bigint")
        return found.select(F.col("__row").alias(row_id), "place_id")
    rows = _keyed(rows.join(entries.select(F.col("country_code").alias("c"), F.col("subdivision_name").alias("u"), F.col("municipality").alias("n")), ["c", "u", "n"], "left_anti"))
    queries = _resolved(rows.select("key", "c", "u", "n").distinct(), entries, blocks)
    best = _in_blocks(queries, entries, blocks, Names, lambda index, q: [(q["key"], *b)] if (b := index.best(*_asked(q)))[1] else [], "key string, penalty double, ties bigint, place_id bigint")
    # only the blocks of the least penalty count
    best = best.groupBy("key", "penalty").agg(F.sum("ties").alias("ties"), F.min("place_id").alias("place_id")).groupBy("key").agg(F.min(F.struct("penalty", "ties", "place_id")).alias("b"))
    answers = rows.select("key").distinct().join(best, "key", "left").select("key", F.when(F.col("b.ties") == 1, F.col("b.place_id")).otherwise(F.lit(0)).cast("long").alias("place_id"))
    return _with_answers(rows, cut(answers)).select(F.col("__row").alias(row_id), "place_id")


def candidates(df: DataFrame, row_id: str, country: str, unit: str, name: str, places: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(row id, place_id, penalty double): for each row whose name isn't null or blank all entries within the distance that the
    text's length allows, with what they cost; the search is made once for rows of the same values, whatever the size of block."""
    rows = _keyed(_typed_rows(df, row_id, country, unit, name))
    entries, blocks = _entries(places, block_entries)
    queries = _resolved(rows.select("key", "c", "u", "n").distinct(), entries, blocks)
    found = _in_blocks(queries, entries, blocks, Names, lambda index, q: [(q["key"], place, float(p)) for p, place in index.candidates(*_asked(q))], "key string, place_id bigint, penalty double")
    return _with_answers(rows, cut(found)).select(F.col("__row").alias(row_id), "place_id", "penalty")
