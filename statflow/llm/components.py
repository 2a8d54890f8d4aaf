"""Connected components of an edge table.

Each round deals the edges by their larger node; a task joins up what its edges
connect (union by smallest label, in arrays) and gives back one edge from each node to
the smallest node it reached. Where such an edge leads to a node with an edge of its
own, the next round first replaces it by that one's end, so paths halve. The rounds end
when all edges lead to nodes without edges. Rounds are written to the shared folder;
edges never leave the executors, and a task holds no more than its partition's edges
(a node has few edges as the larger end; smaller ends may be shared by any number).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import stage


def least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n items the smallest item that pairs (a, b) connect it to."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _join_up(edges: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if parts:
            u, v = (np.concatenate(x) for x in zip(*parts))
            nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
            least = least_linked(len(nodes), index[:len(u)], index[len(u):])
            moved = np.flatnonzero(least != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[moved]), pa.array(nodes[least[moved]])], names=["u", "v"])

    return edges.repartition("u").mapInArrow(run, "u long, v long")


def _is_settled(edges: DataFrame) -> bool:
    """Every node has one edge, and none leads to a node that has one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    odd = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in")).where(
        "out > 1 or (out = 1 and in = 1)")
    return odd.isEmpty()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``(node, lead)`` for every node of the edges ``(u, v)`` (longs): ``lead`` is the
    smallest node of its component, which has a row itself. Pairs of equal nodes are
    ignored."""
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    for _ in range(max_rounds):
        now = stage(_join_up(now), "cc")
        if _is_settled(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("lead")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("lead")).distinct())
        on = stage(now.groupBy("u").agg(F.min("v").alias("w")), "cc-next").withColumnRenamed("u", "__u")
        ahead = now.join(on, F.col("v") == F.col("__u"), "left").select(
            "u", F.coalesce("w", "v").alias("v"))
        # The edge that was followed stays where its own node has others.
        now = ahead.distinct()
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
