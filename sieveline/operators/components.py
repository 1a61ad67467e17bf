"""Connected components of an undirected graph, by alternating stars.

Each round joins every node's neighbours to the smallest of them, first among the
larger neighbours, then among the smaller ones, until the edges are stars. Nothing is
collected: a round is two aggregations and two joins, and its edges are written to the
shared checkpoint folder. A chain of n nodes takes O(log n) rounds. The hub of a large
component has most of its edges at last; edges of such hubs aren't shuffled to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.joins import join_dealt
from sieveline.storage import cut


#: Up to so many edges, one task may have all of them, and joins are left as they are.
FEW = 10_000


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20))).first()
    return tuple(row)


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """``edges`` with ``m``, the smallest of ``a`` and all its ``b``."""
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count(F.lit(1)).alias("n"))
    return edges.join(least.drop("n"), "a") if total <= FEW else join_dealt(edges, cut(least), "a", "n", total)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both, 2 * n).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = _with_least(down, n)
    # The node itself takes the edge to the smallest, its other neighbours follow.
    ends = F.explode(F.array(F.col("a"), F.col("b"))).alias("a")
    return found.select(ends, F.col("m").alias("b")).where("a <> b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row ``(node, component)`` per node of an edge; ``component`` is the smallest node it reaches.

    Edges with a null end, loops and repeated edges change nothing. Nodes without an edge
    are not listed: a left join and ``coalesce(component, node)`` adds them.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    now = cut(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _signature(now)
    while before[0]:
        large = _large_star(now, before[0])
        now = cut(_small_star(large if before[0] <= FEW else cut(large), before[0]))
        after = _signature(now)
        if after == before:
            break
        before = after
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
