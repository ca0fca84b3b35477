"""The region that contains a point: a dual-tree join of points and boxes.

A tree over the points' curve order meets a tree over the boxes': pairs of nodes that don't overlap are discarded, a point node
inside all boxes of a node is accepted wholesale, the rest is refined down to the leaves. A short list of boxes is broadcast and
every task joins its points with it; for a longer one both go to the cells of a pyramid of grids, each box at the level whose cells
are just larger than it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Boxes up to which a list is broadcast (48 bytes each), and the most that a task joins at once.
BOXES_AT_ONCE = 100_000
#: Points of a cell that go to one task.
POINTS_AT_ONCE = 500_000
#: Points that a tree is built over.
TREE_POINTS = 20_000
LEAF = 8
#: Levels of the pyramid: its cells have an edge of 360 degrees, halved from level to level.
LEVELS = 20
_NONE = np.iinfo(np.int64).max


def boxes_of(df: DataFrame, region_id: str, min_lat: Column, max_lat: Column, min_lon: Column, max_lon: Column) -> DataFrame:
    """(region, area, s, n, w, e): boxes with their area in square degrees, latitudes the right way round, those across the 180th
    meridian in two parts."""
    south, north = F.least(min_lat, max_lat), F.greatest(min_lat, max_lat)
    across = min_lon > max_lon
    width = F.when(across, max_lon - min_lon + 360).otherwise(max_lon - min_lon)
    parts = F.when(across, F.array(F.struct(min_lon.alias("w"), F.lit(180.0).alias("e")), F.struct(F.lit(-180.0).alias("w"), max_lon.alias("e")))).otherwise(F.array(F.struct(min_lon.alias("w"), max_lon.alias("e"))))
    out = df.select(F.col(region_id).cast("bigint").alias("region"), (width * (north - south)).alias("area"), south.alias("s"), north.alias("n"), F.explode(parts).alias("p"))
    return out.select("region", "area", "s", "n", "p.w", "p.e").filter("region IS NOT NULL AND area IS NOT NULL")


def _spread(v: np.ndarray) -> np.ndarray:
    """The lower 16 bits with a zero bit between each."""
    v = v.astype(np.int64) & 0xFFFF
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = (v | (v << shift)) & mask
    return v


def _curve(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    return (_spread((np.clip(lat, -90, 90) + 90) / 180 * 65535) << 1) | _spread((np.clip(lon, -180, 180) + 180) / 360 * 65535)


class BoxTree:
    """Boxes (columns s, n, w, e) by rank, the smallest area first and of equal ones the smallest region."""

    def __init__(self, region: np.ndarray, area: np.ndarray, sides: np.ndarray):
        order = np.lexsort((region, area))
        self.region, self.area, sides = region[order], area[order], sides[order]
        place = np.argsort(_curve((sides[:, 0] + sides[:, 1]) / 2, (sides[:, 2] + sides[:, 3]) / 2), kind="stable")
        self.rank, self.sides = place, sides[place]
        leaves = max(1, -(-len(place) // LEAF))
        self.depth = int(np.ceil(np.log2(leaves)))
        size = (1 << self.depth) * LEAF
        # outer: all boxes of a node lie within; inner: what they share; both as low and high corners
        pad = lambda v, fill: np.concatenate([v, np.full(size - len(v), fill)]).reshape(-1, LEAF)
        low, high = [self.sides[:, i] for i in (0, 2)], [self.sides[:, i] for i in (1, 3)]
        self.levels = [{
            "outer_low": np.stack([pad(v, np.inf).min(1) for v in low], 1), "outer_high": np.stack([pad(v, -np.inf).max(1) for v in high], 1),
            "inner_low": np.stack([pad(v, -np.inf).max(1) for v in low], 1), "inner_high": np.stack([pad(v, np.inf).min(1) for v in high], 1),
            "rank": pad(self.rank, _NONE).min(1),
        }]
        for _ in range(self.depth):
            a = self.levels[-1]
            two = lambda k, f, a=a: f(a[k][0::2], a[k][1::2])
            self.levels.append({"outer_low": two("outer_low", np.minimum), "outer_high": two("outer_high", np.maximum), "inner_low": two("inner_low", np.maximum), "inner_high": two("inner_high", np.minimum), "rank": two("rank", np.minimum)})

    def smallest(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        """The rank of the smallest box that holds each point, sides included; the largest number where none does."""
        out = np.full(len(lat), _NONE)
        for at in range(0, len(lat), TREE_POINTS):
            out[at : at + TREE_POINTS] = self._smallest(lat[at : at + TREE_POINTS], lon[at : at + TREE_POINTS])
        return out

    def _smallest(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        n = len(lat)
        best = np.full(n, _NONE)
        if not n or not len(self.rank):
            return best
        order = np.argsort(_curve(lat, lon), kind="stable")
        xy = np.stack([lat[order], lon[order]], 1)
        found = np.full(n, _NONE)
        depth = int(np.ceil(np.log2(max(1, -(-n // LEAF)))))
        size = (1 << depth) * LEAF
        low = [np.concatenate([xy, np.full((size - n, 2), np.inf)]).reshape(-1, LEAF, 2).min(1)]
        high = [np.concatenate([xy, np.full((size - n, 2), -np.inf)]).reshape(-1, LEAF, 2).max(1)]
        for _ in range(depth):
            low.append(np.minimum(low[-1][0::2], low[-1][1::2]))
            high.append(np.maximum(high[-1][0::2], high[-1][1::2]))
        p, q = np.zeros(1, np.int64), np.zeros(1, np.int64)
        up, above = depth, self.depth
        while len(p):
            box = self.levels[above]
            lo, hi = low[up][p], high[up][p]
            meets = ((lo <= box["outer_high"][q]) & (hi >= box["outer_low"][q])).all(1)
            p, q, lo, hi = p[meets], q[meets], lo[meets], hi[meets]
            whole = ((lo >= box["inner_low"][q]) & (hi <= box["inner_high"][q])).all(1)
            if whole.any():
                width = LEAF << up
                rank = np.full(len(low[up]), _NONE)
                np.minimum.at(rank, p[whole], box["rank"][q[whole]])
                found = np.minimum(found, np.repeat(rank, width)[:n])
            p, q = p[~whole], q[~whole]
            if not up and not above:
                self._refine(xy, p, q, found)
                break
            if above >= up and above:
                p, q = np.repeat(p, 2), np.stack([2 * q, 2 * q + 1], 1).ravel()
                above -= 1
            else:
                p, q = np.stack([2 * p, 2 * p + 1], 1).ravel(), np.repeat(q, 2)
                up -= 1
        best[order] = found
        return best

    def _refine(self, xy: np.ndarray, p: np.ndarray, q: np.ndarray, found: np.ndarray) -> None:
        for at in range(0, len(p), 20_000):
            i = (p[at : at + 20_000, None] * LEAF + np.arange(LEAF))[:, :, None]
            j = (q[at : at + 20_000, None] * LEAF + np.arange(LEAF))[:, None, :]
            i, j = (v.ravel() for v in np.broadcast_arrays(i, j))
            real = (i < len(xy)) & (j < len(self.rank))
            i, j = i[real], j[real]
            s = self.sides[j]
            inside = (xy[i, 0] >= s[:, 0]) & (xy[i, 0] <= s[:, 1]) & (xy[i, 1] >= s[:, 2]) & (xy[i, 1] <= s[:, 3])
            np.minimum.at(found, i[inside], self.rank[j[inside]])


def _answers(tree: BoxTree, ids: pa.Array, lat: np.ndarray, lon: np.ndarray) -> pa.RecordBatch:
    rank = tree.smallest(lat, lon)
    none = rank == _NONE
    at = np.where(none, 0, rank)
    region = pa.array(tree.region[at] if len(tree.region) else np.zeros(len(at), np.int64), mask=none)
    area = pa.array(tree.area[at] if len(tree.area) else np.zeros(len(at)), mask=none)
    return pa.RecordBatch.from_arrays([ids, region, area], names=["id", "region", "area"])


def containing(points: DataFrame, point_id: str, lat: Column, lon: Column, boxes: DataFrame, boxes_at_once: int = BOXES_AT_ONCE) -> DataFrame:
    """(point id, region): for each point the smallest box of ``boxes`` (from ``boxes_of``) that holds it, sides included, of equally
    small ones the least region; null where there is none.

    ``point_id`` is unique; points with a null id or place are left out. An empty table gives an empty result, empty boxes null.
    At most ``boxes_at_once`` boxes are broadcast and the points aren't shuffled; beyond it each cell's boxes come in blocks of as
    many, and a cell's points in shares, so neither a crowded spot nor a popular place gathers in a task.
    """
    places = points.select(F.col(point_id).cast("bigint").alias("id"), lat.cast("double").alias("lat"), lon.cast("double").alias("lon")).filter("id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    boxes = cut(boxes)
    schema = "id bigint, region bigint, area double"
    if boxes.count() <= boxes_at_once:
        held = boxes.toArrow()
        shipped = points.sparkSession.sparkContext.broadcast((held["region"].to_numpy(), held["area"].to_numpy(), np.stack([held[c].to_numpy() for c in "snwe"], 1).reshape(-1, 4)))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = BoxTree(*shipped.value)
            for b in batches:
                yield _answers(tree, b.column(0), b.column(1).to_numpy(), b.column(2).to_numpy())

        return places.mapInArrow(scan, schema).select(F.col("id").alias(point_id), "region")
    found = _by_cells(places, boxes, boxes_at_once, schema)
    best = found.filter("region IS NOT NULL").groupBy("id").agg(F.min(F.struct("area", "region")).alias("b")).select(F.col("id").alias("__id"), "b.region")
    return places.join(best, F.col("id") == F.col("__id"), "left").select(F.col("id").alias(point_id), "region")


def _cell(level: Column, y: Column, x: Column) -> Column:
    return (level * (1 << 24) + y) * (1 << 24) + x


def _by_cells(places: DataFrame, boxes: DataFrame, boxes_at_once: int, schema: str) -> DataFrame:
    at = lambda v, offset, level: F.floor((v + offset) / 360.0 * F.pow(F.lit(2.0), level)).cast("bigint")
    extent = F.greatest(F.col("n") - F.col("s"), F.col("e") - F.col("w"), F.lit(1e-9))
    sized = boxes.withColumn("level", F.least(F.floor(F.log2(F.lit(360.0) / extent)), F.lit(LEVELS - 1)).cast("bigint"))
    rows, columns = (F.sequence(at(F.col(a), offset, F.col("level")), at(F.col(b), offset, F.col("level"))) for a, b, offset in (("s", "n", 90), ("w", "e", 180)))
    keyed = sized.withColumn("y", F.explode(rows)).withColumn("x", F.explode(columns)).withColumn("cell", _cell(F.col("level"), F.col("y"), F.col("x"))).select("cell", "region", "area", "s", "n", "w", "e")
    blocks = keyed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / boxes_at_once).cast("int").alias("blocks"))
    # at most LEVELS
    levels = [r[0] for r in sized.select("level").distinct().collect()]
    looked = places.withColumn("level", F.explode(F.array(*[F.lit(v).cast("bigint") for v in levels])))
    looked = looked.select("id", "lat", "lon", _cell(F.col("level"), at(F.col("lat"), 90, F.col("level")), at(F.col("lon"), 180, F.col("level"))).alias("cell")).join(blocks, "cell")
    shares = looked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / POINTS_AT_ONCE).cast("int").alias("shares"))
    asked = looked.join(shares, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("id"), F.col("shares")).cast("int").alias("share"), "id", "lat", "lon")
    held = keyed.join(blocks, "cell").join(shares, "cell").select("cell", F.pmod(F.xxhash64("region", "w"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "region", "area", "s", "n", "w", "e")
    both = held.unionByName(asked, allowMissingColumns=True).repartition("cell", "block", "share").sortWithinPartitions("cell", "block", "share", F.col("region").isNull())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_key, kept, tree = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(keys)], strict=True):
                part = batch.slice(lo, hi - lo)
                if tuple(keys[lo]) != at_key:
                    at_key, kept, tree = tuple(keys[lo]), [], None
                own = part.filter(part.column("region").is_valid())
                if own.num_rows:
                    kept.append(own)
                rest = part.filter(part.column("id").is_valid())
                if rest.num_rows and kept:
                    if tree is None:
                        t = pa.Table.from_batches(kept)
                        tree = BoxTree(t["region"].to_numpy(), t["area"].to_numpy(), np.stack([t[c].to_numpy() for c in "snwe"], 1))
                    yield _answers(tree, rest.column("id"), rest.column("lat").to_numpy(zero_copy_only=False), rest.column("lon").to_numpy(zero_copy_only=False))

    return both.mapInArrow(join, schema)
