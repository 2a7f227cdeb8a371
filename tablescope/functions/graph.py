"""Connected components by contraction.

Every node joins its smallest neighbour, the resulting trees are flattened by
pointer jumping and the graph is contracted to their roots, until few
edges are left.  The frames between rounds are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .skew import lookup

ONE_TASK_EDGES = 1_000_000
FOREST_EDGES = 1_000_000  # gathered before they are made a forest


def _flatten(parents: DataFrame) -> DataFrame:
    """``(node, root)`` of a forest given as ``(node, parent)``, parent <= node."""
    current = cut_lineage(parents.select("node", F.col("parent").alias("root")))
    while True:
        above = current.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = lookup(current, "root", above, "node").select("node", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        jumped = cut_lineage(jumped)
        current = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return current


def _trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge from every node to the smallest node that the edges join it to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    kept = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[kept], nodes[root[kept]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task replaced by trees over its nodes."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size > 2 * len(a) + FOREST_EDGES:
            a, b = _trees(*(np.concatenate([x, *[h.column(i).to_numpy() for h in held]]) for i, x in enumerate((a, b))))
            held, size = [], 0
    if held:
        a, b = _trees(*(np.concatenate([x, *[h.column(i).to_numpy() for h in held]]) for i, x in enumerate((a, b))))
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def connected_components(nodes: DataFrame, edges: DataFrame, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """``(node, root)``, the root being the smallest node of the component.

    ``nodes`` has a column ``node``; ``edges`` has ``a`` and ``b``, whole
    numbers, one row per undirected edge, repetitions and loops allowed.
    Before each round the edges of every task become a forest.  A forest of at
    most ``one_task`` edges is finished in one task; a larger one is
    contracted, at any size.
    """
    def both_ways(e: DataFrame) -> DataFrame:
        e = e.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def forest(e: DataFrame) -> DataFrame:
        e = e.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).filter(F.col("a") != F.col("b"))
        return cut_lineage(e.mapInArrow(_forest, "a bigint, b bigint"))

    trees = forest(edges)
    mapping = nodes.select("node", F.col("node").alias("root"))
    while (size := trees.count()) > one_task:
        graph = cut_lineage(both_ways(trees))
        parents = graph.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("parent"))
        roots = _flatten(parents)
        step = roots.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
        mapping = lookup(mapping, "root", step, "node").select("node", F.coalesce("new_root", "root").alias("root"))
        mapping = cut_lineage(mapping)
        to_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        to_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        half = graph.filter(F.col("a") < F.col("b"))
        moved = lookup(lookup(half, "a", to_a, "b"), "b", to_b, "a")
        trees = forest(moved.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    if size:
        last = trees.coalesce(1).mapInArrow(_forest, "root bigint, new_root bigint")  # at most one_task edges
        mapping = lookup(mapping, "root", last, "node").select("node", F.coalesce("new_root", "root").alias("root"))
    return mapping
