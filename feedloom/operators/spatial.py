"""Points near other points: a dual-tree join, its upper levels distributed.

Centres become points on the unit sphere, so neither poles nor the 180th meridian need care. The upper tree is a grid of cells
of halving edges: only cells with more than ``LEAF_ROWS`` points are divided further, and the smallest crowded ones are split in
blocks of which every pair is joined. Each point goes to the cells that its distance reaches below it, and a pair belongs to the
cell of its lower corner, so that each is found exactly once. Within tasks, whole chunks of cells are joined by a dual tree over
bounding nodes: impossible node pairs are discarded, certain ones accepted wholesale, uncertain leaves refined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_LIMIT_BYTES, cut

EARTH_RADIUS_KM = 6371.0088
#: Points of a cell from which it is divided; also the rows of a block.
LEAF_ROWS = 60_000
#: Rows that a task joins at once (more only where one cell has more).
CHUNK_ROWS = 120_000
#: Edges of the cells of each level, in units of the distance; each is a multiple of the next.
EDGES = (512, 64, 8, 2)
#: The column part is the level times this, plus the pair of blocks.
LEVEL = 1 << 40
#: Points of a leaf of the tree within a task.
TREE_LEAF = 8
#: Pairs of a batch of the result.
PAIRS_OUT = 500_000


def box_centre(min_lat: Column, max_lat: Column, min_lon: Column, max_lon: Column) -> tuple[Column, Column]:
    """Mean latitude and longitude of a box; minimum > maximum longitude crosses the 180th meridian."""
    mid = (min_lon + max_lon) / 2
    across = F.when(mid >= 0, mid - 180).otherwise(mid + 180)
    return (min_lat + max_lat) / 2, F.when(min_lon > max_lon, across).otherwise(mid)


def usable_box(min_lat: Column, max_lat: Column, min_lon: Column, max_lon: Column) -> Column:
    """No null or NaN corner, latitudes within 90, longitudes within 180, not four zeros."""
    within = F.lit(True)
    for c, limit in ((min_lat, 90), (max_lat, 90), (min_lon, 180), (max_lon, 180)):
        within &= c.isNotNull() & c.between(-limit, limit)
    return within & ~((min_lat == 0) & (max_lat == 0) & (min_lon == 0) & (max_lon == 0))


def _cells(level: int, chord: float) -> Column:
    """The packed keys of all cells of the level that a point reaches; mostly one."""
    edge = EDGES[level] * chord
    bits = math.ceil(math.log2(2 / edge + 2))
    if 3 * bits > 62:
        raise ValueError("the distance is too small for a packed key")
    lo = [F.floor((F.col(axis) + (1 - chord)) / edge) for axis in "xyz"]
    hi = [F.floor((F.col(axis) + 1) / edge) for axis in "xyz"]

    def pack(a: Column, b: Column, c: Column) -> Column:
        return F.shiftleft(F.shiftleft(a, bits).bitwiseOR(b), bits).bitwiseOR(c)

    spans = [F.sequence(p, q) for p, q in zip(lo, hi, strict=True)]
    several = F.flatten(F.transform(spans[0], lambda a: F.flatten(F.transform(spans[1], lambda b: F.transform(spans[2], lambda c: pack(a, b, c))))))
    one = (lo[0] == hi[0]) & (lo[1] == hi[1]) & (lo[2] == hi[2])
    return F.when(one, F.array(pack(*hi))).otherwise(several)


def _parent(level: int, chord: float, key: Column) -> Column:
    """The key of the cell of the level above that holds the cell ``key`` of ``level``."""
    bits = math.ceil(math.log2(2 / (EDGES[level] * chord) + 2))
    up = math.ceil(math.log2(2 / (EDGES[level - 1] * chord) + 2))
    by = EDGES[level - 1] // EDGES[level]
    mask = (1 << bits) - 1
    parts = [F.floor(F.shiftright(key, 2 * bits) / by), F.floor(F.shiftright(key, bits).bitwiseAND(F.lit(mask)) / by), F.floor(key.bitwiseAND(F.lit(mask)) / by)]
    return F.shiftleft(F.shiftleft(parts[0], up).bitwiseOR(parts[1]), up).bitwiseOR(parts[2])


def near_pairs(df: DataFrame, row_id: str, lat: Column, lon: Column, group: Column, km: float, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(a, b), a < b: ids (bigint, unique) of all points of different groups at most ``km`` apart on the great circle.

    Points with a null id, place or group are left out (a null group isn't known to differ). Points at the same place are at
    distance 0. An empty table gives an empty result. ``km`` must be far below the earth's radius.
    """
    chord = 2 * math.sin(km / EARTH_RADIUS_KM / 2)
    points = df.select(F.col(row_id).cast("bigint").alias("id"), F.radians(lat).alias("phi"), F.radians(lon).alias("lam"), group.cast("string").alias("grp"))
    points = points.filter(F.col("id").isNotNull() & F.col("phi").isNotNull() & F.col("lam").isNotNull() & F.col("grp").isNotNull())
    points = points.select("id", "grp", (F.cos("phi") * F.cos("lam")).alias("x"), (F.cos("phi") * F.sin("lam")).alias("y"), F.sin("phi").alias("z"))
    # a little more than the distance, for rounding at the cells' limits
    reach = chord * (1 + 1e-9)
    leaves: list[DataFrame] = []
    hot: DataFrame | None = None
    for level in range(len(EDGES)):
        keyed = points.withColumn("cell", F.explode(_cells(level, reach)))
        if hot is not None:
            keyed = keyed.join(hot, _parent(level, reach, F.col("cell")) == F.col("hot_cell"), "left_semi")
        # at most 2 * rows / leaf_rows cells; counted before the shuffle
        hot, found = _counted(keyed.groupBy(F.col("cell").alias("hot_cell")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf_rows))
        calm = keyed.join(hot, F.col("cell") == F.col("hot_cell"), "left_anti") if found else keyed
        leaves.append(calm.select("*", F.lit(level * LEVEL).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("block")))
        if not found:
            break
    else:
        leaves.append(_blocks(keyed, hot, leaf_rows).select(*points.columns, "cell", "part", "block"))
    table = leaves[0]
    for more in leaves[1:]:
        table = table.unionByName(more)
    edges, limit, above = [e * reach for e in EDGES], chord * chord, len(EDGES) * LEVEL

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in whole_cells(batches):
            for a, b in join_chunk(chunk, edges, limit, above):
                for i in range(0, len(a), PAIRS_OUT):
                    yield pa.RecordBatch.from_arrays([pa.array(a[i : i + PAIRS_OUT]), pa.array(b[i : i + PAIRS_OUT])], names=["a", "b"])

    return table.repartition("cell", "part").sortWithinPartitions("cell", "part").mapInArrow(join, "a bigint, b bigint")


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` cut, to be broadcast if its rows are few enough for that, and how many they are."""
    df = cut(df)
    n = df.count()
    return (F.broadcast(df) if n * 100 <= BROADCAST_LIMIT_BYTES else df), n


def _blocks(keyed: DataFrame, hot: DataFrame, leaf_rows: int) -> DataFrame:
    """The rows of the smallest cells that are still crowded, in blocks, once for each pair of blocks: ``part`` is the pair and
    ``block`` the own block, -1 where the pair is a block with itself.

    A group with many rows in a cell gets blocks of its own, which needn't meet each other.
    """
    up = lambda c: F.ceil(c / leaf_rows)
    dense = keyed.join(hot, F.col("cell") == F.col("hot_cell"))
    heavy = dense.groupBy(F.col("cell").alias("h_cell"), F.col("grp").alias("h_grp")).agg(F.count(F.lit(1)).alias("h_n")).filter(F.col("h_n") > leaf_rows).withColumn("h_blocks", up(F.col("h_n")))
    before = Window.partitionBy("h_cell").orderBy("h_grp").rowsBetween(Window.unboundedPreceding, -1)
    heavy, _ = _counted(heavy.withColumn("h_from", F.coalesce(F.sum("h_blocks").over(before), F.lit(0))))
    sums = heavy.groupBy(F.col("h_cell").alias("s_cell")).agg(F.sum("h_n").alias("s_n"), F.sum("h_blocks").alias("s_blocks"))
    cells = hot.join(sums, F.col("hot_cell") == F.col("s_cell"), "left")
    mixed = F.greatest(up(F.col("n") - F.coalesce("s_n", F.lit(0))), F.lit(1))
    cells, _ = _counted(cells.select(F.col("hot_cell").alias("c_cell"), mixed.alias("mixed"), (mixed + F.coalesce("s_blocks", F.lit(0))).alias("total")))
    rows = keyed.join(cells, F.col("cell") == F.col("c_cell")).join(heavy, (F.col("cell") == F.col("h_cell")) & (F.col("grp") == F.col("h_grp")), "left")
    own = F.col("h_blocks").isNotNull()
    first = F.col("mixed") + F.col("h_from")
    block = F.when(own, first + F.pmod(F.xxhash64("id"), F.col("h_blocks"))).otherwise(F.pmod(F.xxhash64("id"), F.col("mixed")))
    rows = rows.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1)))
    rows = rows.filter(~F.coalesce(own & F.col("other").between(first, first + F.col("h_blocks") - 1), F.lit(False)))
    pair = F.least("other", "own") * F.col("total") + F.greatest("other", "own") + len(EDGES) * LEVEL
    return rows.withColumn("part", pair).withColumn("block", F.when(F.col("other") == F.col("own"), -1).otherwise(F.col("own")).cast("bigint"))


def whole_cells(batches: Iterator[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[pa.Table]:
    """The sorted batches in chunks that end between cells."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held)
        cell, part = t["cell"].to_numpy(), t["part"].to_numpy()
        change = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1]))
        if len(change):
            at = int(change[-1]) + 1
            yield t.slice(0, at)
            held, n = t.slice(at).to_batches(), t.num_rows - at
    if n:
        yield pa.Table.from_batches(held)


def _spread_bits(v: np.ndarray) -> np.ndarray:
    """The lower 10 bits with two zero bits between each."""
    v = v.astype(np.int64) & 0x3FF
    for shift, mask in ((16, 0x030000FF), (8, 0x0300F00F), (4, 0x030C30C3), (2, 0x09249249)):
        v = (v | (v << shift)) & mask
    return v


def join_chunk(chunk: pa.Table, edges: list[float], limit: float, above: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ids within the squared chord ``limit``, of the same cell and of different groups, by a dual tree."""
    ids = chunk["id"].to_numpy()
    xyz = np.stack([chunk[c].to_numpy() for c in "xyz"], axis=1)
    cell, part, block = chunk["cell"].to_numpy(), chunk["part"].to_numpy(), chunk["block"].to_numpy()
    grp = chunk["grp"].combine_chunks().dictionary_encode()
    grp = (grp.combine_chunks() if isinstance(grp, pa.ChunkedArray) else grp).indices.to_numpy(zero_copy_only=False)
    _, key = np.unique(np.stack([cell, part], axis=1), axis=0, return_inverse=True)
    key = key.reshape(-1)
    level = np.minimum(part // LEVEL, len(edges) - 1)
    edge = np.asarray(edges)[level]
    # order: cell by cell, within it along a curve through its 1024 parts of each axis
    frac = (xyz + 1) / edge[:, None]
    curve = sum(_spread_bits(np.clip((f - np.floor(f)) * 1024, 0, 1023)) << k for k, f in enumerate(frac.T))
    order = np.lexsort((grp, curve, key))
    ids, xyz, key, grp, block, part, edge = (v[order] for v in (ids, xyz, key, grp, block, part, edge))
    home = np.floor((xyz + 1) / edge[:, None]).astype(np.int64)
    n = len(ids)
    depth = max(0, math.ceil(math.log2(max(1, n / TREE_LEAF))))
    leaves = 1 << depth
    bounds = np.linspace(0, n, leaves + 1).astype(np.int64)
    # the group is bounded too: two nodes of one and the same group hold no pair
    dims = np.concatenate([xyz, key[:, None].astype(float), grp[:, None].astype(float)], axis=1)
    filled = bounds[:-1] < bounds[1:]
    low = [np.full((leaves, 5), np.inf)]
    high = [np.full((leaves, 5), -np.inf)]
    if n:
        low[0][filled] = np.minimum.reduceat(dims, bounds[:-1][filled])
        high[0][filled] = np.maximum.reduceat(dims, bounds[:-1][filled])
    for _ in range(depth):
        low.append(np.minimum(low[-1][0::2], low[-1][1::2]))
        high.append(np.maximum(high[-1][0::2], high[-1][1::2]))

    def checked(i: np.ndarray, j: np.ndarray, measured: bool) -> tuple[np.ndarray, np.ndarray]:
        good = (key[i] == key[j]) & (grp[i] != grp[j])
        if measured:
            d = xyz[i] - xyz[j]
            good &= np.einsum("ij,ij->i", d, d) <= limit
        i, j = i[good], j[good]
        # the pair belongs to the cell of its lower corner; the cell number is that of either point on each axis
        corner = np.minimum(home[i], home[j])
        mine = (corner == owner[i]).all(axis=1)
        # of two blocks the pairs between them, of a block with itself all
        mine &= (part[i] < above) | (block[i] < 0) | (block[i] != block[j])
        i, j = i[mine], j[mine]
        return np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])

    owner = _unpack(chunk, order, edges)
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    a = b = np.zeros(1, np.int64)
    for up in range(depth, -1, -1):
        la, ha, lb, hb = low[up][a], high[up][a], low[up][b], high[up][b]
        gap = np.maximum(0, np.maximum(la - hb, lb - ha))
        alike = (la[:, 4] == ha[:, 4]) & (lb[:, 4] == hb[:, 4]) & (la[:, 4] == lb[:, 4])
        possible = (gap[:, 3] == 0) & ~alike & (np.einsum("ij,ij->i", gap[:, :3], gap[:, :3]) <= limit)
        a, b, la, ha, lb, hb = (v[possible] for v in (a, b, la, ha, lb, hb))
        far = np.maximum(ha, hb) - np.minimum(la, lb)
        certain = (far[:, 3] == 0) & (np.einsum("ij,ij->i", far[:, :3], far[:, :3]) <= limit * (1 - 1e-9)) & (a != b)
        width = 1 << up
        if certain.any():
            yield from _products(bounds[a[certain] * width], bounds[(a[certain] + 1) * width], bounds[b[certain] * width], bounds[(b[certain] + 1) * width], checked, False)
        a, b = a[~certain], b[~certain]
        if not up:
            pending.append((a, b))
            break
        twin = a == b
        ta, oa, ob = a[twin], a[~twin], b[~twin]
        a = np.concatenate((2 * ta, 2 * ta, 2 * ta + 1, 2 * oa, 2 * oa, 2 * oa + 1, 2 * oa + 1))
        b = np.concatenate((2 * ta, 2 * ta + 1, 2 * ta + 1, 2 * ob, 2 * ob + 1, 2 * ob, 2 * ob + 1))
    for a, b in pending:
        twin = a == b
        yield from _products(bounds[a[~twin]], bounds[a[~twin] + 1], bounds[b[~twin]], bounds[b[~twin] + 1], checked, True)
        yield from _products(bounds[a[twin]], bounds[a[twin] + 1], bounds[b[twin]], bounds[b[twin] + 1], checked, True, True)


def _unpack(chunk: pa.Table, order: np.ndarray, edges: list[float]) -> np.ndarray:
    """The cell numbers of each axis that each row's key stands for."""
    cell, part = chunk["cell"].to_numpy()[order], chunk["part"].to_numpy()[order]
    level = np.minimum(part // LEVEL, len(edges) - 1)
    bits = np.array([math.ceil(math.log2(2 / e + 2)) for e in edges])[level]
    mask = (1 << bits) - 1
    return np.stack([cell >> (2 * bits), (cell >> bits) & mask, cell & mask], axis=1)


def _products(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, checked, measured: bool, triangle: bool = False, block: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The products of the spans, in blocks of bounded size."""
    sizes = (a1 - a0) * (b1 - b0)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = int(ends[at] - sizes[at])
        stop = max(at + 1, int(np.searchsorted(ends, done + block, "right")))
        if stop == at + 1 and sizes[at] > block:
            # one large pair of nodes: row by row
            step = max(1, block // int(b1[at] - b0[at]))
            right = np.arange(b0[at], b1[at])
            for lo in range(int(a0[at]), int(a1[at]), step):
                left = np.arange(lo, min(lo + step, int(a1[at])))
                yield checked(np.repeat(left, len(right)), np.tile(right, len(left)), measured)
        else:
            s = sizes[at:stop]
            owner = np.repeat(np.arange(at, stop), s)
            k = np.arange(len(owner)) - np.repeat(np.cumsum(s) - s, s)
            wide = (b1 - b0)[owner]
            i, j = a0[owner] + k // np.maximum(wide, 1), b0[owner] + k % np.maximum(wide, 1)
            if triangle:
                i, j = i[i < j], j[i < j]
            yield checked(i, j, measured)
        at = stop
