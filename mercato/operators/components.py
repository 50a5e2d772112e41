"""Connected components by alternating large-star and small-star contraction.

Each round is two joins on the edge list; the rounds grow with the logarithm of the
number of nodes, not with the diameter. Nothing but two numbers reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mercato.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node reached by each) of undirected edges, in memory."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    low = np.arange(len(nodes))
    join(low, at[: len(u)], at[len(u) :])
    return nodes, nodes[low]


def join(low: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the components of u and v, place by place, in low: the least place of each one's component."""
    while True:
        a, b = low[u], low[v]
        open_ = a != b
        if not open_.any():
            return
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(low, jump := low[low]):
            low[:] = jump


def _in_one_task(edges: DataFrame) -> DataFrame:
    kind = edges.schema["u"].dataType.simpleString()

    def work(batches):
        some = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
        if some:
            nodes, low = least_reached(*(np.concatenate(x) for x in zip(*some)))
            for k in range(0, len(nodes), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + (1 << 16)]), pa.array(low[k : k + (1 << 16)])], names=["node", "component"])

    return edges.select("u", "v").coalesce(1).mapInArrow(work, f"node {kind}, component {kind}")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100, few: int = 0) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reached.

    Edges are undirected; null ends and self edges are ignored, repeats do no harm.
    Nodes without an edge don't appear: their component is themselves. Up to `few` edges are
    searched in one task's memory.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    now = cut(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(max_rounds):
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if seen[0] == 0 or seen == mark:
            break
        if seen[0] <= few:
            return _in_one_task(now)
        mark = seen
        now = cut(_small_star(_large_star(now)).distinct())
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(roots).distinct()
