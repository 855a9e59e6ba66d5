"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.session import remove_path, stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node of its
    component. Self-edges and repeated edges are allowed, NULL ends are ignored.

    Every round maps each node to the least neighbour seen so far (large-star, then
    small-star), which needs O(log n) rounds even for long chains. Each round writes its edges
    to the shared folder; per node only a ``min`` is gathered, combined on the map side, so a
    node with a third of all edges is no bottleneck: the join that follows is on the node and
    AQE splits its skewed partitions. Empty input gives an empty result; not converging within
    ``max_rounds`` is an error, never a partial answer."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    # v > u always; self-edges only keep lone nodes known
    cur = stage(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    nodes = cur.select(F.col("u").alias("node")).union(cur.select(F.col("v").alias("node"))).distinct()
    lone_safe = nodes
    work = cur.where("u <> v")
    before = None
    for _ in range(max_rounds):
        # large-star: join every larger neighbour of x to the least of x and its neighbours
        both = work.union(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: join every smaller neighbour of x, and x, to the least of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low2.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        work = stage(small, "cc")
        # the edge set no longer changes iff its size and its order-free hash stay the same
        now = tuple(work.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    label = work.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return lone_safe.join(label, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
