"""Parent-child links to full hierarchies by pointer doubling.

Each round joins every unfinished node's pointer with the pointer of the node that it points to, which doubles the distance
covered. Depths along a chain have no gaps, so a round in which nothing reaches a root proves that the rest lies on loops or
on ways into them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .skew import hot_keys, salted_lookup


#: Finished nodes for each unfinished one from which the pointed-to are picked out before the join.
FEW = 4


def links(df: DataFrame, node: str, parent: str) -> DataFrame:
    """(id, parent), both as text, of the rows with both; a node that occurs more than once keeps its least parent."""
    pairs = df.select(F.col(node).cast("string").alias("id"), F.col(parent).cast("string").alias("parent"))
    return pairs.filter(F.col("id").isNotNull() & F.col("parent").isNotNull()).groupBy("id").agg(F.min("parent").alias("parent"))


def roots(edges: DataFrame) -> DataFrame:
    """(id, root, depth, looped) for each row of ``edges`` (id, parent; id unique).

    ``root`` is where the chain ends, even if no row has that id, and ``depth`` the number of steps. Nodes on a loop or on a
    way into one have a null root, depth -1 and looped true; a node that is its own parent is a loop. An empty table gives an
    empty one. Every round is cut by a checkpoint of the nodes unfinished before it, and hot pointers are salted.
    """
    first = cut(edges.select("id", F.col("parent").alias("ptr"), F.lit(1).cast("bigint").alias("dist"), F.lit(False).alias("done")))

    def advance(joined: DataFrame) -> DataFrame:
        ends = F.col("k").isNull()
        return joined.select(
            "id",
            F.when(ends, F.col("ptr")).otherwise(F.col("k_ptr")).alias("ptr"),
            F.when(ends, F.col("dist")).otherwise(F.col("dist") + F.col("k_dist")).alias("dist"),
            (ends | F.col("k_done")).alias("done"),
        )

    state = _doubled(first, advance)
    return state.select("id", F.when(F.col("done"), F.col("ptr")).alias("root"), F.when(F.col("done"), F.col("dist")).otherwise(-1).cast("int").alias("depth"), (~F.col("done")).alias("looped"))


def _doubled(first: DataFrame, advance: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The state (id, ptr, ..., done) after as many rounds as it takes, or after one in which nothing was done.

    Each round looks up what the unfinished nodes point to and ``advance``s them; only their new state is written. The states of
    the finished stay where they were written; once they are many beside the unfinished, only those that are pointed to come to the
    join.
    """
    active, finished = first, None
    rows, finished_rows = first.count(), 0
    while rows:
        known = active if finished is None else active.unionByName(finished)
        if finished_rows > FEW * rows:
            wanted = active.select(F.col("ptr").alias("w")).distinct()
            known = known.join(wanted, known["id"] == wanted["w"], "left_semi")
        known = known.select(F.col("id").alias("k"), *[F.col(c).alias(f"k_{c}") for c in known.columns if c != "id"])
        step = cut(advance(salted_lookup(active, known, "ptr", "k", "id", hot_keys(active, "ptr", rows))))
        done = step.filter("done")
        finished = done if finished is None else finished.unionByName(done)
        active = step.filter(~F.col("done"))
        left = active.count()
        if left == rows:
            break
        rows, finished_rows = left, finished_rows + rows - left
    return active if finished is None else active.unionByName(finished)


def paths(edges: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(id, path) for each node that ends at a root: the ids from the node itself up to its root.

    Looped nodes are left out first, so the segments stay within the depths. Segments are concatenated by the same doubling.
    """
    found = roots(edges) if found is None else found
    first = found.filter(~F.col("looped")).select("id").join(edges, "id").select("id", F.array("parent").alias("seg"), F.lit(False).alias("done"))
    first = cut(first.withColumn("ptr", F.element_at("seg", -1)))

    def advance(joined: DataFrame) -> DataFrame:
        ends = F.col("k").isNull()
        step = joined.select("id", F.when(ends, F.col("seg")).otherwise(F.concat("seg", "k_seg")).alias("seg"), (ends | F.col("k_done")).alias("done"))
        return step.withColumn("ptr", F.element_at("seg", -1))

    return _doubled(first, advance).select("id", F.concat(F.array("id"), "seg").alias("path"))


def descendants(all_paths: DataFrame) -> DataFrame:
    """(ancestor, descendant, steps): every node's descendants, one row each; from ``paths``."""
    each = all_paths.select(F.col("id").alias("descendant"), F.posexplode("path").alias("steps", "ancestor"))
    return each.filter("steps > 0").select("ancestor", "descendant", "steps")


def descendant_counts(all_paths: DataFrame) -> DataFrame:
    """(ancestor, n_descendants, deepest), pre-aggregated before the shuffle."""
    return descendants(all_paths).groupBy("ancestor").agg(F.count(F.lit(1)).alias("n_descendants"), F.max("steps").alias("deepest"))


def loop_members(edges: DataFrame, found: DataFrame) -> DataFrame:
    """(id, loop_id, loop_size) of the nodes on loops themselves; ``loop_id`` is the loop's least id.

    Every looped node has its one parent among the looped nodes. A node on a loop is reached from any node that is 2^k steps
    before it, k rounds on, so the pointers after enough doublings are exactly the loops' nodes; the least id seen on the way
    is doubled along with them.
    """
    looped = found.filter("looped").select("id").join(edges, "id")
    state = cut(looped.select("id", F.col("parent").alias("ptr"), F.least("id", "parent").alias("least")))
    total = state.count()
    covered = 1
    while covered < total:
        known = state.select(F.col("id").alias("k"), F.col("ptr").alias("k_ptr"), F.col("least").alias("k_least"))
        joined = salted_lookup(state, known, "ptr", "k", "id", hot_keys(state, "ptr", total), "inner")
        state = cut(joined.select("id", F.col("k_ptr").alias("ptr"), F.least("least", "k_least").alias("least")))
        covered *= 2
    members = state.select(F.col("ptr").alias("id")).distinct()
    # a member's least id over more steps than there are nodes is its loop's
    own = state.join(members, "id").select("id", F.col("least").alias("loop_id"))
    return own.join(own.groupBy("loop_id").agg(F.count(F.lit(1)).alias("loop_size")), "loop_id").select("id", "loop_id", "loop_size")
