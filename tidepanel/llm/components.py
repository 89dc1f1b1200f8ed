"""Connected components over an edge table, by alternating large-star and small-star.

Both steps are a minimum for each node and a join back. A node's arcs are dealt
to ``SPREAD`` parts by their other end: minima are taken in the parts, then over
them, and come back to the parts, so that of a hub's arcs no task has more than
about one in ``SPREAD``, and from node to node at most ``SPREAD`` rows travel. All
joins merge, as minima grow with the nodes and are never broadcast. Each round is
written to the shared folder. Only DataFrame operations; nothing is collected but
two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import drop, materialize

#: Rounds grow with the logarithm of the longest path; this many mean a fault.
MAX_ROUNDS = 60
#: Parts of a node's arcs.
SPREAD = 32


def _with_lowest(arcs: DataFrame) -> DataFrame:
    """arcs (u, v) with m, the lowest of u and its neighbours."""
    dealt = arcs.withColumn("r", F.pmod(F.xxhash64("v"), F.lit(SPREAD))).repartition("u", "r")
    # Parts and arcs share the exchange.
    parts = dealt.groupBy("u", "r").agg(F.min("v").alias("m"))
    low = parts.groupBy("u").agg(F.min("m").alias("m"))
    back = parts.select("u", "r").join(low.hint("merge"), "u").select("u", "r", F.least("u", "m").alias("m"))
    return dealt.join(back.hint("merge"), ["u", "r"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    arcs = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_lowest(arcs).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges have u > v and differ, so just one of a node's has v = m."""
    return _with_lowest(edges).select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the lowest node that is reachable) for every node with an edge.

    Nodes may be of any type that orders. Null ends, loops and repeated edges
    add nothing. Nodes without an edge don't appear. No edges, no rows.
    """
    links = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(current)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        after = materialize(_small_star(_large_star(current)), "edges")
        drop(current)
        current, before = after, mark
        mark = _mark(current)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
