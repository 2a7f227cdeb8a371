"""Isolation Forest (Liu, Ting and Zhou, 2008) over a distributed table.

Only the training samples, at most 256 rows per tree, are gathered; every row
of the table is scored where it lies.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.ordered import quantile_parameters
from ..functions.values import col

TREES = 100
SAMPLE_ROWS = 256
POOL_ROWS = 50_000  # drawn from the table, for all trees to draw from
HASH_RANGE = 2**31


def average_path(n: float) -> float:
    """Expected path length of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _hash(key: str, *salts) -> "F.Column":
    return F.pmod(F.xxhash64(col(key), *salts), F.lit(HASH_RANGE))


def tree_samples(numbers: DataFrame, cols: list[str], key: str, n_rows: int, seed: int, trees: int = TREES) -> DataFrame:
    """``(tree, x0, x1, ...)``: a uniform sample without replacement for each tree.

    Each row is drawn into a pool by one hash, at every size of the table; a
    table of fewer rows is its own pool.  The trees draw from the pool.
    """
    pooled = min(1.0, POOL_ROWS / max(n_rows, 1))
    # draw some more than needed, then cut each tree to its exact size
    share = min(1.0, (1.3 * SAMPLE_ROWS + 50) / max(n_rows * pooled, 1))
    limit = F.lit(int(HASH_RANGE * share))
    hashes = F.array(*[_hash(key, F.lit(t), F.lit(seed)) for t in range(trees)])
    drawn = (
        numbers.select(col(key), *[col(c).alias(f"x{i}") for i, c in enumerate(cols)])
        .filter(_hash(key, F.lit("pool"), F.lit(seed)) < F.lit(int(HASH_RANGE * pooled)))
        .withColumn("_hs", hashes)
        .filter(F.array_min("_hs") < limit)
        .select("*", F.posexplode("_hs").alias("tree", "_h"))
        .filter(F.col("_h") < limit)
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_h", col(key)))
    return drawn.withColumn("_n", place).filter(F.col("_n") <= SAMPLE_ROWS).select("tree", *[f"x{i}" for i in range(len(cols))])


def _grower(axes: int, seed: int, limit: int):
    """Function that grows one tree from its sample."""

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        points = pdf[[f"x{i}" for i in range(axes)]].to_numpy(float)
        points = points[np.lexsort(points.T)]  # rows arrive in any order
        rng = np.random.default_rng([seed, tree])
        nodes, todo = [], [(0, np.arange(len(points)), 0)]
        count = 1
        while todo:
            node, rows, depth = todo.pop()
            low, high = points[rows].min(axis=0), points[rows].max(axis=0)
            open_axes = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or len(open_axes) == 0:
                nodes.append((tree, node, -1, 0.0, 0, 0, depth + average_path(len(rows))))
                continue
            axis = int(rng.choice(open_axes))
            cut = float(rng.uniform(low[axis], high[axis]))
            goes_left = points[rows, axis] <= cut
            nodes.append((tree, node, axis, cut, count, count + 1, 0.0))
            todo.append((count, rows[goes_left], depth + 1))
            todo.append((count + 1, rows[~goes_left], depth + 1))
            count += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "axis", "cut", "left", "right", "path"])

    return grow


def isolation_scores(numbers: DataFrame, cols: list[str], key: str, seed: int = 42, trees: int = TREES) -> DataFrame:
    """Rows with ``iforest_score`` in (0, 1]; higher means easier to isolate."""
    n_rows = numbers.agg(F.count(F.lit(1))).first()[0]
    if n_rows == 0:
        return numbers.withColumn("iforest_score", F.lit(None).cast("double"))
    sample_rows = min(SAMPLE_ROWS, n_rows)
    limit = math.ceil(math.log2(max(sample_rows, 2)))
    schema = "tree int, node int, axis int, cut double, left int, right int, path double"
    samples = tree_samples(numbers, cols, key, n_rows, seed, trees)
    grown = samples.groupBy("tree").applyInPandas(_grower(len(cols), seed, limit), schema)
    # at most trees * (2 * 256 - 1) nodes, whatever the table size
    nodes = grown.toPandas()
    ids = {t: i for i, t in enumerate(sorted(nodes["tree"].unique()))}
    width = int(nodes["node"].max()) + 1
    # a leaf leads to itself on both sides
    axis, path = np.zeros((len(ids), width), np.intp), np.zeros((len(ids), width))
    cut, child = np.full((len(ids), width), np.inf), np.repeat(np.arange(width), 2).reshape(1, -1).repeat(len(ids), axis=0)
    t, k, inner = nodes["tree"].map(ids).to_numpy(), nodes["node"].to_numpy(), nodes["axis"].to_numpy() >= 0
    path[t, k] = nodes["path"]
    t, k, inside = t[inner], k[inner], nodes[inner]
    axis[t, k], cut[t, k] = inside["axis"], inside["cut"]
    child[t, 2 * k], child[t, 2 * k + 1] = inside["left"], inside["right"]
    forest = numbers.sparkSession.sparkContext.broadcast((axis, cut, child, path))
    scale = average_path(sample_rows) or 1.0

    @F.pandas_udf("double")
    def score(*values: pd.Series) -> pd.Series:
        axis, cut, child, path = forest.value
        x = np.column_stack([v.to_numpy(float) for v in values])
        flat, first, total = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x))
        for tree in range(len(axis)):
            at = np.zeros(len(x), np.intp)
            for _ in range(limit):
                right = flat.take(first + axis[tree].take(at)) > cut[tree].take(at)
                at = child[tree].take(2 * at + right)
            total += path[tree].take(at)
        return pd.Series(np.power(2.0, -(total / len(axis)) / scale))

    return numbers.withColumn("iforest_score", score(*[col(c) for c in cols]))


def isolation_forest_flags(
    numbers: DataFrame, cols: list[str], key: str, contamination: float | str = "auto", seed: int = 42, trees: int = TREES
) -> DataFrame:
    """Rows with ``iforest_score`` and ``is_isolation_forest``.

    ``auto`` flags scores above one half; a fraction flags the scores above
    the exact quantile that leaves that share of the rows.
    """
    scored = isolation_scores(numbers, cols, key, seed, trees)
    limit = 0.5
    if contamination != "auto":
        found = quantile_parameters(scored, ["iforest_score"], {"q": 1.0 - float(contamination)})
        limit = found["iforest_score"]["q"]
    flag = F.col("iforest_score") > F.lit(limit) if limit is not None else F.lit(False)
    return scored.withColumn("is_isolation_forest", F.coalesce(flag, F.lit(False)))
