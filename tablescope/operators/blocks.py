"""Exact nearest distances, near boxes and distance sums, part against part.

Points are cut into a k-d tree whose leaves hold a bounded number of them.
Leaves meet in pairs, found by descending the tree in pairs of nodes: a pair
is one group that holds the points of both, so no task holds more, nothing
passes through the driver and only what was asked for is written.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.values import col
from ..session import cut_lineage

LEAF_ROWS = 2_000
LEAF_BOXES = 200
ROUND_BITS = 6  # a leaf is cut into at most 64 at once
STEP_BITS = 3  # and pairs of nodes into at most 64 pairs
SAMPLE_ROWS = 4_000  # of a leaf, to choose its cuts
FILL = 0.9  # of a leaf that is cut no more, as the sample tells
MOST_ROUNDS = 10
GRID_ROWS = 32  # rows of a part per square root of all rows, for distance sums
SAME = 1e-12  # relative slack of a bound, for the rounding of distances
PAIR_CELLS = 500_000  # distances held at once
NEAR_CELLS = 32_000  # the same between near leaves, few enough for the cache of a core
LOOP_AXES = 4  # columns whose differences are taken one by one
LOST = 1e-5  # of the squares, below which a squared distance is taken from differences
FAR_AXES = 2  # columns for which distance sums go through the tree
DIRECT_ROWS = 20_000  # distinct rows that all meet each other
NEAR_ROWS = 700  # of a leaf of that tree
MOST_LEAVES = 40_000  # boxes known to the driver
FAR = 2.0  # half widths between two boxes whose points need not meet
NODES = 14  # places of a grid along an axis
CHEBYSHEV = np.cos((np.arange(NODES) + 0.5) * np.pi / NODES)
TO_NODES = np.cos(np.arange(NODES)[:, None] * np.arccos(CHEBYSHEV)[None, :]) * np.where(np.arange(NODES) == 0, 1.0, 2.0)[:, None] / NODES


def _axes(d: int) -> list[str]:
    return [f"x{i}" for i in range(d)]


def _best_cut(x: np.ndarray) -> tuple[int, float] | None:
    """Axis and value that part the rows most evenly into those above and the rest; of about equal ones the widest axis."""
    best = None
    for axis in range(x.shape[1]):
        column = x[:, axis]
        middle = np.partition(column, len(column) // 2)[len(column) // 2]
        below = column[column < middle]
        for cut in ([middle] if (column > middle).any() else []) + ([below.max()] if len(below) else []):
            uneven = abs((column > cut).mean() - 0.5)
            rank = (round(uneven, 1), -float(np.ptp(column)))
            if best is None or rank < best[0]:
                best = rank, axis, float(cut)
    return best and best[1:]


def _cuts(x: np.ndarray, enough: float) -> tuple[list[int], list[float]]:
    """A complete tree of ``ROUND_BITS`` levels in heap order; rows above the cut go right, at an infinite one none do.

    Nodes of at most ``enough`` rows are not cut.
    """
    axis, cut = [0] * (2**ROUND_BITS - 1), [math.inf] * (2**ROUND_BITS - 1)
    todo = [(1, x)]
    while todo:
        node, rows = todo.pop()
        found = _best_cut(rows) if node < 2**ROUND_BITS and len(rows) > max(1, enough) else None
        if found is None:
            continue
        axis[node - 1], cut[node - 1] = found
        right = rows[:, found[0]] > found[1]
        todo += [(2 * node, rows[~right]), (2 * node + 1, rows[right])]
    return axis, cut


def tree(points: DataFrame, d: int, leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, int]:
    """``points`` (distinct in x0..) with their ``leaf``, and how many bits its number has.

    The leaves that hold too many points are cut again and again.  Where to
    cut is chosen on a sample of each; that steers the work only.  The bits of
    a leaf are its way down from the root.
    """
    axes = _axes(d)
    points, bits = cut_lineage(points.withColumn("leaf", F.lit(0).cast("bigint"))), 0
    sampled = F.pmod(F.xxhash64(*axes), F.lit(1 << 20)) < F.lit(float((1 << 20) * SAMPLE_ROWS)) / F.col("n")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        axis, cut = _cuts(pdf[axes].to_numpy(float), FILL * leaf_rows * len(pdf) / pdf["n"].iloc[0])
        return pd.DataFrame({"leaf": pdf["leaf"].iloc[:1], "axis": [axis], "cut": [cut]})

    for _ in range(MOST_ROUNDS):
        open_ = points.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf_rows)
        cuts = cut_lineage(points.join(open_, "leaf").where(sampled).select("leaf", "n", *axes).groupBy("leaf").applyInPandas(plan, "leaf bigint, axis array<int>, cut array<double>"))
        if cuts.isEmpty():
            break
        side = lambda node, _: 2 * node + (F.element_at(F.array(*axes), F.element_at("axis", node) + 1) > F.element_at("cut", node)).cast("int")
        way = F.aggregate(F.sequence(F.lit(1), F.lit(ROUND_BITS)), F.lit(1), side) - 2**ROUND_BITS
        placed = points.join(cuts, "leaf", "left").withColumn("leaf", F.col("leaf") * 2**ROUND_BITS + F.when(F.col("cut").isNull(), 0).otherwise(way))
        points, bits = cut_lineage(placed.drop("axis", "cut")), bits + ROUND_BITS
    return points, bits


def _ends(d: int) -> list[tuple[str, str]]:
    return [(f"{n}{i}", f"x{i}") for i in range(d) for n in ("lo", "hi")]


def _gap(d: int) -> Column:
    """Distance between the boxes of nodes a and b."""
    total = F.lit(0.0)
    for i in range(d):
        apart = F.greatest(F.col(f"a.lo{i}") - F.col(f"b.hi{i}"), F.col(f"b.lo{i}") - F.col(f"a.hi{i}"), F.lit(0.0))
        total = total + apart * apart
    return F.sqrt(total)


def leaf_pairs(leaves: DataFrame, bits: int, d: int) -> DataFrame:
    """Pairs ``(i, j)`` of leaves, each with itself too, whose boxes are no farther apart than the ``bound`` of i.

    ``leaves`` has leaf, lo0, hi0, .., bound.  Only children of pairs of nodes
    that are near are looked at.
    """
    merged = [f(f"{n}{i}").alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))]
    pairs, level = leaves.limit(1).select(F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j")), 0
    while level < bits:
        step = STEP_BITS if level else ROUND_BITS
        level += step
        nodes = leaves.groupBy(F.shiftright("leaf", bits - level).alias("node")).agg(*merged, F.max("bound").alias("bound"))
        nodes = cut_lineage(nodes.withColumn("parent", F.shiftright("node", step)))
        met = pairs.join(nodes.alias("a"), F.col("i") == F.col("a.parent")).join(nodes.alias("b"), F.col("j") == F.col("b.parent"))
        pairs = cut_lineage(met.where(_gap(d) <= F.col("a.bound") * (1 + SAME)).select(F.col("a.node").alias("i"), F.col("b.node").alias("j")))
    return pairs


def near_boxes(boxes: DataFrame, d: int, radius: float, leaf_rows: int = LEAF_BOXES) -> DataFrame:
    """Pairs ``(a, b)`` of ids of boxes ``(id, lo0, hi0, ..)`` no farther than ``radius`` apart, in both orders and each with itself.

    Boxes go by their lowest corners, which are distinct.
    """
    ends = [n for n, _ in _ends(d)]
    placed, bits = tree(boxes.select("id", *ends, *[F.col(f"lo{i}").alias(f"x{i}") for i in range(d)]), d, leaf_rows)
    placed = placed.drop(*_axes(d))
    merged = [f(f"{n}{i}").alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))]
    leaves = placed.groupBy("leaf").agg(*merged).withColumn("bound", F.lit(float(radius)))
    pairs = leaf_pairs(cut_lineage(leaves) if bits else leaves, bits, d).where("i <= j")
    first = placed.join(pairs, placed["leaf"] == pairs["i"]).drop("leaf")
    second = placed.join(pairs.where("i < j"), placed["leaf"] == pairs["j"]).drop("leaf")
    held = first.withColumn("right", F.lit(False)).unionByName(second.withColumn("right", F.lit(True)))

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        right = pdf["right"].to_numpy()
        same = not right.any()
        x, y = pdf[~right], pdf if same else pdf[right]
        lo = [[p[f"lo{i}"].to_numpy() for i in range(d)] for p in (x, y)]
        hi = [[p[f"hi{i}"].to_numpy() for i in range(d)] for p in (x, y)]
        a, b, step = [], [], max(1, 4_000_000 // len(y))
        for s in range(0, len(x), step):
            total = np.zeros((len(x[s : s + step]), len(y)))
            for i in range(d):
                apart = np.maximum(lo[0][i][s : s + step, None] - hi[1][i][None, :], lo[1][i][None, :] - hi[0][i][s : s + step, None])
                np.maximum(apart, 0.0, out=apart)
                total += apart * apart
            p, q = np.nonzero(np.sqrt(total) <= radius)
            a.append(x["id"].to_numpy()[p + s])
            b.append(y["id"].to_numpy()[q])
        a, b = np.concatenate(a), np.concatenate(b)
        return pd.DataFrame({"a": a, "b": b} if same else {"a": np.concatenate([a, b]), "b": np.concatenate([b, a])})

    return held.groupBy("i", "j").applyInPandas(near, "a bigint, b bigint")


def _near(x: np.ndarray, y: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """Per row of x the k smallest distances to the rows of y, each counted w times (infinite beyond the last)."""
    out = np.full((len(x), k), np.inf)
    copies = np.repeat(y, np.minimum(w, k), axis=0)
    step = max(1, 4_000_000 // max(1, len(copies)))
    for s in range(0, len(x), step):
        d2 = np.zeros((len(x[s : s + step]), len(copies)))
        for j in range(x.shape[1]):
            gap = x[s : s + step, j, None] - copies[None, :, j]
            d2 += gap * gap
        m = min(k, len(copies))
        out[s : s + step, :m] = np.sort(np.partition(d2, m - 1, axis=1)[:, :m], axis=1)
    return np.sqrt(out)


def kth_distances(scaled: DataFrame, cols: list[str], key: str, k: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``(key, k_distance)`` for every row: the distance to its k-th nearest row, itself included.

    Equal rows are one point with a weight.  The k-th distance inside the own
    leaf bounds the search of a point; only leaves whose boxes are within the
    largest such bound of a leaf are looked at, and of what they hold only
    distances below the bound of a point are written.
    """
    d, axes, partners = len(cols), _axes(len(cols)), [f"y{i}" for i in range(len(cols))]
    rows = scaled.select(col(key).alias("key"), *[(col(c).cast("double") + 0.0).alias(x) for c, x in zip(cols, axes)])
    distinct = rows.groupBy(*axes).agg(F.count(F.lit(1)).alias("w")).withColumn("id", F.monotonically_increasing_id())
    points, bits = tree(cut_lineage(distinct), d, leaf_rows)

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[axes].to_numpy(float)
        near = _near(x, x, pdf["w"].to_numpy(), k)
        return pdf[["leaf", "id", "w", *axes]].assign(near=list(near), bound=near[:, k - 1])

    first = cut_lineage(points.groupBy("leaf").applyInPandas(own, "leaf bigint, id bigint, w bigint, " + "".join(f"{x} double, " for x in axes) + "near array<double>, bound double"))
    ends = [f(x).alias(f"{n}{i}") for i, x in enumerate(axes) for n, f in (("lo", F.min), ("hi", F.max))]
    leaves = cut_lineage(first.groupBy("leaf").agg(*ends, F.max("bound").alias("bound")))
    others = leaf_pairs(leaves, bits, d).where("i != j")
    mine = first.select(F.col("leaf").alias("i"), "id", "bound", *axes).join(others, "i")
    theirs = first.select(F.col("leaf").alias("j"), F.col("w").alias("v"), *[F.col(x).alias(y) for x, y in zip(axes, partners)])
    theirs = theirs.join(others.select(F.col("i").alias("i2"), "j"), "j").withColumnRenamed("i2", "i")

    def against(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": pd.Series([], dtype="int64"), "near": pd.Series([], dtype="float64")})
        near = _near(a[axes].to_numpy(float), b[partners].to_numpy(float), b["v"].to_numpy(), k)
        row, at = np.nonzero(near < a["bound"].to_numpy()[:, None])
        return pd.DataFrame({"id": a["id"].to_numpy()[row], "near": near[row, at]})

    more = mine.groupBy("i", "j").cogroup(theirs.groupBy("i", "j")).applyInPandas(against, "id bigint, near double")
    every = cut_lineage(more)
    # the own leaf's list is needed only where another leaf has something nearer
    lists = first.join(every.select("id").distinct(), "id", "left_semi").select("id", F.explode("near").alias("near"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("near"))  # only the k nearest leave a task
    found = every.unionByName(lists).withColumn("place", place).where(F.col("place") <= k).groupBy("id").agg(F.max("near").alias("k_distance"))
    settled = first.join(found, "id", "left").select(*axes, F.coalesce("k_distance", "bound").alias("k_distance"))
    return rows.join(settled, axes).select(F.col("key").alias(key), "k_distance")


# --------------------------------------------------------------- distance sums
def _pair_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows of x to all rows of y.

    Many columns go through a matrix product; pairs so near that it would lose
    digits are then taken from their differences.
    """
    if x.shape[1] <= LOOP_AXES:
        d2 = np.zeros((len(x), len(y)))
        for q in range(x.shape[1]):
            gap = x[:, q, None] - y[None, :, q]
            gap *= gap
            d2 += gap
        return np.sqrt(d2, out=d2)
    size = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
    d2 = x @ (-2.0 * y.T)
    d2 += size
    size *= LOST
    near, at = np.nonzero(~(d2 > size))
    step = max(1, PAIR_CELLS // x.shape[1])
    for s in range(0, len(near), step):
        gap = x[near[s : s + step]] - y[at[s : s + step]]
        d2[near[s : s + step], at[s : s + step]] = (gap * gap).sum(axis=1)
    return np.sqrt(d2, out=d2)


def _members(label: np.ndarray, n: np.ndarray, groups: dict[str, int]) -> np.ndarray:
    """Per row and group the number of equal rows in it; ``label`` has a column per labelling."""
    n = n.astype(float)[:, None]
    return np.concatenate([(label[:, k, None] == np.arange(m)[None, :]) * n for k, m in enumerate(groups.values())], axis=1)


def distance_sums(labelled: DataFrame, cols: list[str], groups: dict[str, int], block_rows: int | None = None) -> DataFrame:
    """``(id, *groups, n, sums)``: per row the sums of its distances to the members of every group.

    ``groups`` names the label columns and their number of groups, numbered
    from 0; a label below 0 is in no group.  Rows of one or two columns that
    are equal come once, with their number ``n``.  More than ``DIRECT_ROWS``
    of those go through a tree; otherwise every row meets every row.
    """
    axes, labels = _axes(len(cols)), list(groups)
    flat = len(cols) <= FAR_AXES
    rows = labelled.select(*[(col(c).cast("double") + 0.0).alias(x) for c, x in zip(cols, axes)], *[col(c) for c in labels])
    rows = rows.groupBy(*axes, *[col(c) for c in labels]).agg(F.count(F.lit(1)).alias("n")) if flat else rows.withColumn("n", F.lit(1).cast("bigint"))
    rows = cut_lineage(rows.withColumn("id", F.monotonically_increasing_id()))
    most = F.greatest(*[F.abs(x) for x in axes], F.lit(0.0))
    n, finite = rows.agg(F.count(F.lit(1)), F.count_if((most < math.inf) & F.concat(*[F.col(x).cast("string") for x in axes]).isNotNull())).first()
    if flat and not block_rows and n > DIRECT_ROWS and n == finite:
        return _tree_sums(rows, n, axes, groups)
    return _all_pairs_sums(rows, n, axes, groups, block_rows)


def _all_pairs_sums(rows: DataFrame, n: int, axes: list[str], groups: dict[str, int], block_rows: int | None) -> DataFrame:
    """Every part meets every part once; the parts grow with the square root of the table, and so does the number of copies of a row."""
    labels = list(groups)
    parts = max(1, math.ceil(n / max(block_rows or LEAF_ROWS, 0 if block_rows else GRID_ROWS * math.sqrt(n))))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("other")
    placed = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).select("*", other)
    placed = placed.select("id", "n", *axes, *[col(c) for c in labels], "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    width = sum(groups.values())

    def against(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        a = pdf[pdf["part"] == i]
        b = a if i == j else pdf[pdf["part"] == j]
        x, y = a[axes].to_numpy(float), b[axes].to_numpy(float)
        middle = y.mean(axis=0) if len(y) else 0.0
        x, y = x - middle, y - middle
        member = [_members(p[labels].to_numpy(), p["n"].to_numpy(), groups) for p in (a, b)]
        left, right, step = np.zeros((len(x), width)), np.zeros((len(y), width)), max(1, PAIR_CELLS // max(1, len(y)))
        for s in range(0, len(x), step):
            distance = _pair_distances(x[s : s + step], y)
            left[s : s + step] = distance @ member[1]
            if i != j:
                right += distance.T @ member[0][s : s + step]
        out = [(a, left)] if i == j else [(a, left), (b, right)]
        return pd.DataFrame(np.concatenate([v for _, v in out]), columns=[f"s{g}" for g in range(width)]).assign(id=np.concatenate([p["id"].to_numpy() for p, _ in out]))

    partial = placed.groupBy("i", "j").applyInPandas(against, "".join(f"s{g} double, " for g in range(width)) + "id bigint")
    summed = partial.groupBy("id").agg(F.array(*[F.sum(f"s{g}") for g in range(width)]).alias("sums"))  # combined in the task first
    return rows.select("id", *[col(c) for c in labels], "n").join(summed, "id")


def _basis(x: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Per row the values of the polynomials that are one at a node of the grid of ``box`` and zero at its other nodes."""
    out = np.ones((len(x), 1))
    for axis in range(x.shape[1]):
        lo, hi = box[:, axis]
        half = (hi - lo) / 2
        t = np.clip((x[:, axis] - (lo + hi) / 2) / half, -1, 1) if half > 0 else np.zeros(len(x))
        at = np.cos(np.arange(NODES) * np.arccos(t)[:, None]) @ TO_NODES
        out = (out[:, :, None] * at[:, None, :]).reshape(len(x), -1)
    return out


def _nodes(box: np.ndarray) -> np.ndarray:
    """The points of the grid of a box, in the order of :func:`_basis`."""
    middle, half = box.mean(axis=0), (box[1] - box[0]) / 2
    return np.stack([g.ravel() for g in np.meshgrid(*[m + h * CHEBYSHEV for m, h in zip(middle, half)], indexing="ij")], axis=1)


def _meetings(leaf: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Pairs of nodes far apart, pairs of leaves that are not, both in both orders, and the boxes of the nodes.

    Node ``2**level + code`` has the leaves whose first ``level`` bits are
    ``code``.  Together the pairs hold every pair of leaves once.
    """
    order = np.argsort(leaf)
    leaf, low, high = leaf[order], low[order], high[order]
    i = j = np.zeros(1, np.int64)
    far, boxes = [], {}
    for level in range(bits + 1):
        code, first = np.unique(leaf >> (bits - level), return_index=True)
        lo, hi = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        name = code + (1 << level)
        half = ((hi - lo) / 2).max(axis=1)
        gap = np.maximum(np.maximum(lo[i] - hi[j], lo[j] - hi[i]), 0.0)
        apart = np.sqrt((gap * gap).sum(axis=1)) >= FAR * np.maximum(half[i], half[j])
        far.append(np.stack([name[i[apart]], name[j[apart]]], axis=1))
        boxes |= {int(m): np.stack([lo[k], hi[k]]) for k, m in enumerate(name)}
        i, j = i[~apart], j[~apart]
        if level < bits:
            below = np.unique(leaf >> (bits - level - 1))
            child = np.searchsorted(below >> 1, code)
            more = np.diff(np.append(child, len(below))) == 2
            i, j = (np.concatenate(v) for v in zip(*[(child[i[m]] + a, child[j[m]] + b) for a in (0, 1) for b in (0, 1) for m in [(more[i] | (a == 0)) & (more[j] | (b == 0))]]))
    far = np.concatenate(far)
    return far, np.stack([leaf[i], leaf[j]], axis=1), {k: boxes[k] for k in np.unique(far).tolist()}


def _tree_sums(rows: DataFrame, n: int, axes: list[str], groups: dict[str, int]) -> DataFrame:
    """Sums over leaves that are near taken row by row, over nodes that are far through polynomials of distance.

    Between two boxes whose gap is at least ``FAR`` times their half widths,
    distance is a smooth function: it equals the polynomial through its values
    on a grid of ``NODES`` places an axis up to less than 1e-10 of itself.  So
    the rows of a node act as weights at its grid, and what a node receives
    is known from the values at its own.  Work grows with the rows.
    """
    spark, labels, width, d = rows.sparkSession, list(groups), sum(groups.values()), len(axes)
    points, bits = tree(rows.withColumnRenamed("n", "times"), d, max(NEAR_ROWS, n // MOST_LEAVES))
    points = points.withColumnRenamed("times", "n")
    ends = [f(x) for f in (F.min, F.max) for x in axes]
    found = np.array([tuple(r) for r in points.groupBy("leaf").agg(*ends).collect()], dtype=object)  # one row per leaf
    leaf, box = found[:, 0].astype(np.int64), found[:, 1:].astype(float)
    far, near, boxes = _meetings(leaf, box[:, :d], box[:, d:], bits)
    above = np.stack([(leaf >> (bits - level)) + (1 << level) for level in range(bits + 1)], axis=1)
    pairs = lambda some, *names: spark.createDataFrame(pa.table({c: some[:, k] for k, c in enumerate(names)}))

    def weigh(pdf: pd.DataFrame) -> pd.DataFrame:
        code, x, member = int(pdf["leaf"].iloc[0]), pdf[axes].to_numpy(float), _members(pdf[labels].to_numpy(), pdf["n"].to_numpy(), groups)
        mine = [m for m in ((code >> (bits - level)) + (1 << level) for level in range(bits + 1)) if m in boxes]
        return pd.DataFrame({"node": pd.Series(mine, dtype="int64"), "w": [(_basis(x, boxes[m]).T @ member).tobytes() for m in mine]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"node": pdf["node"].iloc[:1], "w": [sum(np.frombuffer(w) for w in pdf["w"]).tobytes()]})

    def receive(pdf: pd.DataFrame) -> pd.DataFrame:
        at, got = _nodes(boxes[int(pdf["i"].iloc[0])]), 0.0
        for j, w in zip(pdf["j"].tolist(), pdf["w"]):
            got = got + _pair_distances(at, _nodes(boxes[j])) @ np.frombuffer(w).reshape(-1, width)
        return pd.DataFrame({"node": pdf["i"].iloc[:1], "got": [got.tobytes()]})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {"x": pdf[axes].to_numpy(float), "g": pdf[labels].to_numpy(np.int64), "n": pdf["n"].to_numpy(np.int64), "id": pdf["id"].to_numpy(np.int64)}
        return pd.DataFrame({"leaf": pdf["leaf"].iloc[:1], **{c: [v.tobytes()] for c, v in parts.items()}})

    def settle(pdf: pd.DataFrame, received: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["id"].tolist()
        own = next(k for k, v in enumerate(ids) if v is not None)
        spots, marks, counts = [np.frombuffer(v).reshape(-1, d) for v in pdf["x"]], [np.frombuffer(v, np.int64).reshape(-1, len(labels)) for v in pdf["g"]], [np.frombuffer(v, np.int64) for v in pdf["n"]]
        x = spots[own]
        sums = np.zeros((len(x), width))
        for y, mark, count in zip(spots, marks, counts):
            member, step = _members(mark, count, groups), max(1, NEAR_CELLS // len(y))
            for s in range(0, len(x), step):
                sums[s : s + step] += _pair_distances(x[s : s + step], y) @ member
        for node, got in zip(received["node"].tolist(), received["got"]):
            sums += _basis(x, boxes[node]) @ np.frombuffer(got).reshape(-1, width)
        return pd.DataFrame(marks[own], columns=labels).assign(n=counts[own], id=np.frombuffer(ids[own], np.int64), sums=list(sums))

    weights = cut_lineage(points.groupBy("leaf").applyInPandas(weigh, "node bigint, w binary")).groupBy("node").applyInPandas(total, "node bigint, w binary")
    met = pairs(far, "i", "j").join(cut_lineage(weights), F.col("j") == F.col("node")).select("i", "j", "w")
    received = cut_lineage(met.groupBy("i").applyInPandas(receive, "node bigint, got binary"))
    owners = pairs(np.stack([np.repeat(leaf, bits + 1), above.ravel()], axis=1), "i", "node")
    received = owners.join(received, "node").select("i", "node", "got")
    # rows of a leaf go as one, so a copy costs its bytes only
    packed = cut_lineage(points.groupBy("leaf").applyInPandas(pack, "leaf bigint, x binary, g binary, n binary, id binary"))
    close = pairs(near, "i", "j").join(packed, F.col("j") == F.col("leaf")).select("i", "j", "x", "g", "n", F.when(F.col("i") == F.col("j"), F.col("id")).alias("id"))
    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in labels)
    return close.groupBy("i").cogroup(received.groupBy("i")).applyInPandas(settle, f"{kinds}n bigint, id bigint, sums array<double>")
