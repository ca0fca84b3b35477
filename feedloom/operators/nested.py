"""Nested JSON records turned into linked flat tables.

Structural indexing over whole Arrow batches: bitmaps of quotes, brackets and delimiters, nesting depth by prefix sums, and
from the order by depth each container's slots with the spans of their keys and values. Only the wanted kinds are walked,
level by level, all records at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bytescan import BACKSLASH, QUOTE, Texts, last_where, next_where, pieces, spans

#: Bytes of text indexed at once.
PIECE_BYTES = 1 << 20


@dataclass(frozen=True)
class Kinds:
    """Which keys are nodes: at the top of a record, and within the nodes of each kind. ``bare`` kinds may be held as a bare
    scalar, which then is the field ``bare_field``."""

    top: tuple[str, ...]
    within: dict[str, tuple[str, ...]] = field(default_factory=dict)
    bare: tuple[str, ...] = ()
    bare_field: str = "id"


CATALOG_KINDS = Kinds(top=("location", "urls", "redirect"), within={"location": ("bounding_box",), "redirect": ("urls", "redirect")}, bare=("redirect",))


class StructuralIndex:
    """The slots of all containers in an array of JSON texts.

    A slot is an array element or an object's member: its container's open bracket, its number from 0, the span of its key
    (objects only, with quotes) and the first and last byte of its value. Texts that are unbalanced have no containers.
    """

    def __init__(self, texts: pa.Array):
        self.t = t = Texts(texts)
        data, row = t.data, t.row
        n = len(data)
        pos = np.arange(n)
        # quotes that aren't escaped: an even run of backslashes before them
        slash = data == BACKSLASH
        run_start = np.maximum(last_where(~slash)[:-1] + 1, t.start[row]) if n else pos
        quote = (data == QUOTE) & ((pos - run_start) % 2 == 0)
        inside = (t.since_start(quote) % 2).astype(bool)  # from the opening quote up to before the closing one
        outside = ~inside & ~quote
        opens = outside & ((data == 0x7B) | (data == 0x5B))
        closes = outside & ((data == 0x7D) | (data == 0x5D))
        delims = outside & ((data == 0x2C) | (data == 0x3A))
        depth = t.since_start(opens).astype(np.int64) - t.since_start(closes)
        white = (data == 32) | ((data >= 9) & (data <= 13))
        ink = ~white
        self.next_ink, self.last_ink = next_where(ink), last_where(ink)
        lowest = np.zeros(t.n, np.int64)
        if n:
            np.minimum.at(lowest, row[closes], depth[closes])
        balanced = (t.per_row(quote) % 2 == 0) & (t.per_row(opens) == t.per_row(closes)) & (lowest >= 0)
        structural = pos[(opens | closes | delims) & balanced[row]] if n else pos
        level = depth[structural] + closes[structural]  # an end bracket belongs to the level that it ends
        order = np.lexsort((structural, level, row[structural]))
        s = structural[order]
        is_open, is_close, is_comma = opens[s], closes[s], data[s] == 0x2C
        is_colon = delims[s] & ~is_comma
        # within a row and level, every run from an open bracket is one container; a delimiter at level 0 belongs to none
        good = level[order] > 0
        s, is_open, is_close, is_comma, is_colon = s[good], is_open[good], is_close[good], is_comma[good], is_colon[good]
        container = np.cumsum(is_open) - 1
        self.open_at = s[is_open]
        self.close_at = s[is_close] if is_close.sum() == is_open.sum() else np.zeros(0, np.int64)
        if len(self.close_at) != len(self.open_at):
            raise ValueError("unbalanced containers")
        is_object = data[self.open_at] == 0x7B if len(s) else np.zeros(0, bool)
        # slots begin after an open bracket or a comma and end before the next comma or end bracket
        begin = is_open | is_comma
        slot_container = container[begin]
        slot_from = s[begin] + 1
        stop = is_comma | is_close
        slot_to = s[stop]
        slot_of = np.cumsum(begin) - 1
        colon_at = np.full(len(slot_from), -1)
        colons = np.flatnonzero(is_colon)[::-1]
        colon_at[slot_of[colons]] = s[colons]
        keyed = is_object[slot_container] & (colon_at >= 0)
        value_from = np.where(keyed, colon_at + 1, slot_from)
        first = self.next_ink[value_from]
        last = self.last_ink[slot_to]
        empty = first >= slot_to
        number = np.arange(len(slot_from)) - np.flatnonzero(np.concatenate(([True], slot_container[1:] != slot_container[:-1])))[slot_container] if len(slot_from) else slot_from
        ok = ~empty & (keyed | ~is_object[slot_container])
        self.container, self.number = slot_container[ok], number[ok]
        self.first, self.last = first[ok], last[ok]
        self.key_first, self.key_last = self.next_ink[slot_from[ok]], self.last_ink[np.maximum(colon_at[ok], 0)]
        self.keyed = keyed[ok]
        self.by_open = np.argsort(self.open_at, kind="stable")
        # slots are in the order of their containers
        self.slot_lo = np.searchsorted(self.container, np.arange(len(self.open_at)), "left")
        self.slot_hi = np.searchsorted(self.container, np.arange(len(self.open_at)), "right")

    def container_at(self, positions: np.ndarray) -> np.ndarray:
        """The container that opens at each position, or -1."""
        if not len(self.open_at):
            return np.full(len(positions), -1)
        sorted_open = self.open_at[self.by_open]
        i = np.minimum(np.searchsorted(sorted_open, positions), len(sorted_open) - 1)
        return np.where(sorted_open[i] == positions, self.by_open[i], -1)

    def slots(self, containers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All slots of the containers, and for each the place of its container in the argument."""
        sizes = self.slot_hi[containers] - self.slot_lo[containers]
        owner = np.repeat(np.arange(len(containers)), sizes)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.slot_lo[containers][owner] + within, owner

    def keys_equal(self, slots: np.ndarray, name: str) -> np.ndarray:
        """Which of the slots have the key ``name``; escaped keys are decoded one by one."""
        t, want = self.t, name.encode()
        a, b = self.key_first[slots], self.key_last[slots]
        same = self.keyed[slots] & (b - a == len(want) + 1) & (t.at(a) == QUOTE)
        for i, c in enumerate(want):
            same &= t.at(a + 1 + i) == c
        if len(self.backslashes):
            longer = np.flatnonzero(self.keyed[slots] & (b - a > len(want) + 1) & (t.at(a) == QUOTE))
            escaped = np.searchsorted(self.backslashes, b[longer]) > np.searchsorted(self.backslashes, a[longer])
            for i in longer[escaped]:
                same[i] = _loads(self.text(a[i], b[i])) == name
        return same

    @cached_property
    def backslashes(self) -> np.ndarray:
        """Where the text has a backslash."""
        return np.flatnonzero(self.t.data == BACKSLASH)

    def text(self, first: int, last: int) -> str:
        return self.t.data[first : last + 1].tobytes().decode()

    def raw(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The texts from each first to each last byte, as written."""
        return spans(self.t.data, first, last + 1)

    def strings(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The JSON strings from each first to each last quote, decoded; null for one with a wrong escape. Only those with a
        backslash are looked at one by one, and all of them in one go."""
        plain = spans(self.t.data, first + 1, np.maximum(last, first + 1))
        escaped = np.flatnonzero(np.searchsorted(self.backslashes, last) > np.searchsorted(self.backslashes, first)) if len(self.backslashes) else []
        if not len(escaped):
            return plain
        quoted = self.raw(first[escaped], last[escaped]).to_pylist()
        decoded = _loads("[" + ",".join(quoted) + "]")
        decoded = [_loads(q) for q in quoted] if decoded is None else decoded
        place = np.arange(len(first))
        place[escaped] = len(first) + np.arange(len(escaped))
        return pa.concat_arrays([plain, pa.array(decoded, pa.string())]).take(pa.array(place))


@dataclass
class _Values:
    """Values to look at: first and last byte, and of each the record, parent path and, for an element, its index (-1: the
    member's own value)."""

    first: np.ndarray
    last: np.ndarray
    record: np.ndarray
    parent: pa.Array
    index: np.ndarray


@dataclass
class _Found:
    """Nodes in columns, piece by piece."""

    record: list[np.ndarray] = field(default_factory=list)
    columns: dict[str, list[pa.Array]] = field(default_factory=lambda: {c: [] for c in ("kind", "parent_path", "node_path", "fields")})

    def add(self, record: np.ndarray, kind: str, parent: pa.Array, path: pa.Array, fields: pa.Array) -> None:
        self.record.append(record)
        for column, piece in zip(self.columns.values(), (pa.repeat(pa.scalar(kind, pa.string()), len(record)), parent, path, fields), strict=True):
            column.append(piece)


def _loads(text: str) -> object:
    try:
        return json.loads(text)
    except ValueError:
        return None


def _paths(parent: pa.Array, kind: str, index: np.ndarray) -> pa.Array:
    """Each parent's path with ``kind[index]`` behind it."""
    before = pc.if_else(pc.equal(parent, ""), "", pc.binary_join_element_wise(parent, "", "."))
    return pc.binary_join_element_wise(before, f"{kind}[", pa.array(index).cast(pa.string()), "]", "")


def _maps(owner: np.ndarray, n: int, keys: pa.Array, values: pa.Array) -> pa.Array:
    """A map for each of ``n`` owners (ascending); of a repeated key the last value holds."""
    codes = pc.dictionary_encode(keys).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs = owner * (codes.max(initial=0) + 1) + codes
    _, from_end = np.unique(pairs[::-1], return_index=True)
    if len(from_end) < len(pairs):
        last = np.sort(len(pairs) - 1 - from_end)
        owner, keys, values = owner[last], keys.take(pa.array(last)), values.take(pa.array(last))
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int32)
    return pa.MapArray.from_arrays(pa.array(offsets), keys, values)


def extract_nodes(texts: pa.Array, kinds: Kinds = CATALOG_KINDS) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """(record: place in ``texts``, columns kind, parent_path, node_path and fields, a map of the node's scalar fields)."""
    out = _Found()
    # (texts, record of each, parent path of each, kind, index of each or -1); the first has no kind: whole records
    work: list[tuple[pa.Array, np.ndarray, pa.Array, str | None, np.ndarray]] = [(texts, np.arange(len(texts)), pa.repeat(pa.scalar("", pa.string()), len(texts)), None, np.full(len(texts), -1))]
    while work:
        array, record, parent, kind, index = work.pop()
        ix = StructuralIndex(array)
        first = ix.next_ink[np.minimum(ix.t.start, len(ix.t.data))]
        last = ix.last_ink[ix.t.end]
        some = (ix.t.end > ix.t.start) & (first < ix.t.end)
        start = _Values(first[some], last[some], record[some], parent.filter(pa.array(some)), index[some])
        if kind is None:
            tops = ix.container_at(start.first)
            ok = (tops >= 0) & (ix.t.at(start.first) == 0x7B)
            todo = _members(ix, tops[ok], start.record[ok], start.parent.filter(pa.array(ok)), kinds.top)
        else:
            todo = [(kind, start)]
        while todo:
            # level by level, all values of a kind at once
            level: dict[str, list[_Values]] = {}
            for kind_, values in todo:
                if len(values.first):
                    level.setdefault(kind_, []).append(values)
            todo = [below for kind_, parts in level.items() for below in _visit(ix, kind_, _together(parts), kinds, out, work)]
    columns = {c: pa.concat_arrays(p) if p else pa.array([], pa.map_(pa.string(), pa.string()) if c == "fields" else pa.string()) for c, p in out.columns.items()}
    return np.concatenate(out.record) if out.record else np.zeros(0, np.int64), columns


def _together(parts: list[_Values]) -> _Values:
    if len(parts) == 1:
        return parts[0]
    whole = {c: np.concatenate([getattr(p, c) for p in parts]) for c in ("first", "last", "record", "index")}
    return _Values(parent=pa.concat_arrays([p.parent for p in parts]), **whole)


def _members(ix: StructuralIndex, containers: np.ndarray, record: np.ndarray, parent: pa.Array, names: tuple[str, ...]) -> list[tuple[str, _Values]]:
    """The values of the named members of objects; of a repeated key the last."""
    slots, owner = ix.slots(containers)
    found = []
    for name in names:
        hit = np.flatnonzero(ix.keys_equal(slots, name))
        if len(hit):
            hit = hit[np.concatenate((owner[hit][1:] != owner[hit][:-1], [True]))]
            s, o = slots[hit], owner[hit]
            found.append((name, _Values(ix.first[s], ix.last[s], record[o], parent.take(pa.array(o)), np.full(len(s), -1))))
    return found


def _visit(ix: StructuralIndex, kind: str, v: _Values, kinds: Kinds, out: _Found, work: list) -> list[tuple[str, _Values]]:
    """Adds the nodes among ``v`` and returns the values below them; texts that hold JSON go to ``work``, all in one array."""
    lead = ix.t.at(v.first)
    opened = ix.container_at(v.first)
    below: list[tuple[str, _Values]] = []
    # an array held by the member itself: its elements, nulls counted
    listed = (lead == 0x5B) & (opened >= 0) & (v.index < 0)
    if listed.any():
        slots, owner = ix.slots(opened[listed])
        src = np.flatnonzero(listed)[owner]
        below.append((kind, _Values(ix.first[slots], ix.last[slots], v.record[src], v.parent.take(pa.array(src)), ix.number[slots])))
    at = np.maximum(v.index, 0)

    def bare(which: np.ndarray, texts: pa.Array) -> None:
        if len(which):
            parent = v.parent.take(pa.array(which))
            fields = _maps(np.arange(len(which)), len(which), pa.repeat(pa.scalar(kinds.bare_field, pa.string()), len(which)), texts)
            out.add(v.record[which], kind, parent, _paths(parent, kind, at[which]), fields)

    # texts: JSON within, or a bare value
    held = np.flatnonzero(lead == QUOTE)
    if len(held):
        texts = ix.strings(v.first[held], v.last[held]).fill_null("")
        bodies = pc.utf8_trim_whitespace(texts)
        opens = pc.match_substring_regex(bodies, r"^[{\[]").to_numpy(zero_copy_only=False)
        json_like = np.flatnonzero(opens)
        json_like = json_like[[_loads(b) is not None for b in bodies.take(pa.array(json_like)).to_pylist()]] if len(json_like) else json_like
        if len(json_like):
            src = held[json_like]
            work.append((bodies.take(pa.array(json_like)), v.record[src], v.parent.take(pa.array(src)), kind, v.index[src]))
        if kind in kinds.bare:
            other = pc.not_equal(bodies, "").to_numpy(zero_copy_only=False)
            other[json_like] = False
            bare(held[other], texts.filter(pa.array(other)))
    if kind in kinds.bare:
        numbers = np.flatnonzero(((lead >= 0x30) & (lead <= 0x39)) | (lead == 0x2D))
        bare(numbers, ix.raw(v.first[numbers], v.last[numbers]))
    # objects with a field that isn't null
    objects = np.flatnonzero((lead == 0x7B) & (opened >= 0))
    if not len(objects):
        return below
    slots, owner = ix.slots(opened[objects])
    null = (ix.t.at(ix.first[slots]) == ord("n")) & (ix.last[slots] - ix.first[slots] == 3)
    filled = np.bincount(owner[~null], minlength=len(objects)) > 0
    keep = np.flatnonzero(filled)
    src = objects[keep]
    scalar = np.flatnonzero(~null & (ix.container_at(ix.first[slots]) < 0) & filled[owner])
    s, new_owner = slots[scalar], (np.cumsum(filled) - 1)[owner[scalar]]
    quoted = ix.t.at(ix.first[s]) == QUOTE
    keys = ix.strings(ix.key_first[s], ix.key_last[s]).fill_null("")
    values = pc.if_else(pa.array(quoted), ix.strings(ix.first[s], np.where(quoted, ix.last[s], ix.first[s] + 1)), ix.raw(ix.first[s], np.where(quoted, ix.first[s], ix.last[s])))
    parent = v.parent.take(pa.array(src))
    paths = _paths(parent, kind, at[src])
    out.add(v.record[src], kind, parent, paths, _maps(new_owner, len(src), keys, values))
    return below + _members(ix, opened[src], v.record[src], paths, kinds.within.get(kind, ()))


def flatten_records(df: DataFrame, key: str, payload: str, kinds: Kinds = CATALOG_KINDS) -> DataFrame:
    """Rows (key, kind, parent_path, node_path, fields map<string,string>): one for each node of the wanted kinds with at
    least one field that isn't null, also within JSON text held by a string; a bare value of a bare kind is a node.

    ``parent_path`` with the key refers to the parent's ``node_path`` and is '' at the top. ``fields`` holds the node's
    scalar fields that aren't null, numbers as written; of a repeated key the last value holds. Null, empty and
    unbalanced payloads give no rows, nor do arrays in arrays. Repeated records give their rows again under their own key.
    No shuffle: one scan.
    """
    narrow = df.select(key, payload)
    schema = T.StructType([df.schema[key], *[T.StructField(n, T.StringType(), False) for n in ("kind", "parent_path", "node_path")], T.StructField("fields", T.MapType(T.StringType(), T.StringType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, [1], PIECE_BYTES):
                record, columns = extract_nodes(part.column(1), kinds)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(record)), *columns.values()], names=[key, *columns])

    return narrow.mapInArrow(scan, schema)


def flat_table(nodes: DataFrame, key: str, kind: str, columns: dict[str, str]) -> DataFrame:
    """One kind's table: key, parent_path, node_path and the named fields, cast (null where the text doesn't cast)."""
    from pyspark.sql import functions as F

    cast = [F.try_element_at("fields", F.lit(c)).try_cast(t).alias(c) for c, t in columns.items()]
    return nodes.filter(F.col("kind") == kind).select(key, "parent_path", "node_path", *cast)
