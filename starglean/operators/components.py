"""Connected components by alternating large-star and small-star steps, or in one task if the edges are few."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_round

#: Edges that one task connects; more of them take the steps.
TASK_EDGES = 1 << 21


def local_roots(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """Least node of each node's component in a graph held by one task."""
    root = np.arange(nodes)
    while True:
        low = np.minimum(root[a], root[b])
        nxt = root.copy()
        np.minimum.at(nxt, root[a], low)
        np.minimum.at(nxt, root[b], low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, root):
            return root
        root = nxt


def _in_one_task(edges: DataFrame) -> DataFrame:
    key = dict(edges.dtypes)["u"]

    def connect(table: pa.Table) -> pa.Table:
        ends = np.concatenate([table.column("u").to_numpy(), table.column("v").to_numpy()])
        ids, at = np.unique(ends, return_inverse=True)
        root = local_roots(at[: table.num_rows], at[table.num_rows :], len(ids))
        return pa.table({"node": ids, "component": ids[root]})

    return cut_round(edges.groupBy(F.lit(0).alias("all")).applyInArrow(connect, f"node {key}, component {key}"))


def components(edges: DataFrame, src: str = "src", dst: str = "dst", task_edges: int = TASK_EDGES) -> DataFrame:
    """``node``, ``component`` (the least node id) for every node of an edge.

    Up to ``task_edges`` edges are one task's work.  Beyond that each step hangs neighbours under the least node they see; the star shape is
    reached in O(log^2 n) steps.  A node's least neighbour comes from a combining
    aggregate, and the join back to its edges is one adaptive execution can
    split, so a hub with a third of all edges is not one task's work.
    """
    current = cut_round(
        edges.select(F.greatest(src, dst).alias("v"), F.least(src, dst).alias("u")).filter("u <> v").distinct()
    )
    if current.limit(task_edges + 1).count() <= task_edges:
        return _in_one_task(current)
    state = None
    while True:
        # Large star: larger neighbours of x move under the least of x and its neighbours.
        both = current.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            current.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        # Small star: x and its smaller neighbours move under the least of them.
        large = large.filter("u <> v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(low, "v")
        small = joined.select(F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u")).filter("u <> v").distinct()
        current = cut_round(small)
        now = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    leaves = current.select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = current.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return leaves.unionByName(roots)
