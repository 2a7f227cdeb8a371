"""Sharding by a k-d tree over metadata dimensions.

The table of (row id, weight, coordinates) is split again and again at the
weighted median of the widest dimension, until there is one leaf per shard;
a node that has to hold an odd number of shards is split in proportion.

A median is found by digits: all nodes of a level count the weight per value
of the next 16 bits of the split key, the bucket that crosses the target is
kept, and the next digits are counted inside it, until the bucket weighs less
than ``tolerance`` of a shard.  A key is the coordinate, then the group of the
row, then a hash of the row, so rows of one group stay together unless the
group itself is heavier than the tolerance; only then it is divided.

The driver holds the tree, at most two nodes per shard, never rows.  Every
level is one pass or a few over the narrow table, and only the level below is
kept.  All of it is DataFrame work.

Defined cases: null coordinates sort lowest; a null text weighs only the
overhead of a row; repeated rows are rows of their own; an empty table gives
an empty result; fewer rows than shards leave some shards empty.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import Scratch

ROW_OVERHEAD = 8
TOLERANCE = 0.002  # of the weight of a shard
ROWS_PER_NUMBERING = 50_000
# Shifts of the digits: two of the coordinate, two of the group, two of the row's hash.
DIGITS = [("k", 48), ("k", 32), ("k", 16), ("k", 0), ("t", 16), ("t", 0)]


@dataclass
class Node:
    """A part of the data that has to fill ``leaves`` shards, the first of them being ``first``."""

    id: int
    first: int
    leaves: int
    weight: int = 0
    dim: int = 0
    low: float = 0.0
    high: float = 0.0
    target: float = 0.0  # weight still to be found inside the bucket
    k: int = 0
    t: int = 0
    inside: int = 0  # weight of the bucket
    open: bool = True


def _case(nodes: list[Node], value, kind: str, node: str = "node") -> Column:
    """The value of the row's node; the nodes of one level, at most one per shard."""
    pairs = [F.lit(x) for n in nodes for x in (n.id, value(n))]
    return F.create_map(*pairs)[F.col(node)].cast(kind)


def _spread(points: DataFrame, nodes: list[Node], dims: int, scale: list[float]) -> None:
    """Weight and widest dimension of each node."""
    ends = [f(f"d{i}").cast("double").alias(f"{a}{i}") for i in range(dims) for f, a in ((F.min, "lo"), (F.max, "hi"))]
    found = {r["node"]: r for r in points.groupBy("node").agg(F.sum("w").alias("w"), *ends).collect()}
    for n in nodes:
        if r := found.get(n.id):
            n.weight = int(r["w"])
            n.dim = max(range(dims), key=lambda i: ((r[f"hi{i}"] - r[f"lo{i}"]) / scale[i], -i))
            n.low, n.high = r[f"lo{n.dim}"], r[f"hi{n.dim}"]
        n.target = n.weight * (n.leaves // 2) / n.leaves
        n.k, n.t, n.inside, n.open = 0, 0, n.weight, n.weight > 0


def _keyed(points: DataFrame, nodes: list[Node], dims: int) -> DataFrame:
    """The rows of the nodes with the split keys ``k`` (coordinate in 31 bits, group in 32) and ``t`` (hash of the row)."""
    coordinate = reduce(lambda a, i: F.when(F.col("_dim") == i, F.col(f"d{i}")).otherwise(a), range(1, dims), F.col("d0")).cast("double")
    part = (coordinate - F.col("_low")) / F.greatest(F.col("_high") - F.col("_low"), F.lit(1e-300))
    rows = points.where(F.col("node").isin([n.id for n in nodes])).withColumns(
        {"_dim": _case(nodes, lambda n: n.dim, "int"), "_low": _case(nodes, lambda n: n.low, "double"), "_high": _case(nodes, lambda n: n.high, "double")}
    )
    high = F.least(F.floor(part * (2**31 - 1)), F.lit(2**31 - 1)).cast("bigint")
    return rows.withColumns({"k": F.shiftleft(high, 32) + F.col("g"), "t": F.col("r")})


def _find(keyed: DataFrame, nodes: list[Node], tolerance: float) -> None:
    """Fix the split of every node: rows with (k, t) <= (node.k, node.t) go left."""
    for place, (key, shift) in enumerate(DIGITS):
        now = [n for n in nodes if n.open]
        if not now:
            return
        rows = keyed.where(F.col("node").isin([n.id for n in now]))
        if place:
            before = DIGITS[place - 1][1] if key == DIGITS[place - 1][0] else 64
            rows = rows.where(F.col("k") == _case(now, lambda n: n.k, "bigint")) if key == "t" else rows
            if before < 64:
                rows = rows.where(F.shiftright(F.col(key), before) == _case(now, lambda n: getattr(n, key) >> before, "bigint"))
        digit = F.shiftright(F.col(key), shift)
        buckets = rows.groupBy("node", digit.alias("b")).agg(F.sum("w").alias("w"))
        up_to = F.sum("w").over(W.partitionBy("node").orderBy("b"))  # at most 65,536 buckets per node
        crossing = buckets.withColumn("c", up_to).where(F.col("c") >= _case(now, lambda n: n.target, "double"))
        found = {r["node"]: r["x"] for r in crossing.groupBy("node").agg(F.min(F.struct("b", "w", "c")).alias("x")).collect()}
        for n in now:
            b, w, c = found[n.id]
            below = c - w
            upper, lower = ((b + 1) << shift) - 1, (b << shift) - 1
            last = place == len(DIGITS) - 1
            if w <= tolerance or last or (key == "k" and shift == 0 and w <= 2 * tolerance):
                chosen = upper if c - n.target <= n.target - below else lower
                if key == "k":
                    n.k, n.t = chosen, 2**32
                else:
                    n.t = chosen
                n.open = False
            else:
                setattr(n, key, b << shift)
                n.target -= below
                n.inside = w


def shard(rows: DataFrame, weight: Column, dims: list[Column], group: Column, identity: Column, shards: int, keep: list[Column], tolerance: float = TOLERANCE) -> DataFrame:
    """``keep`` columns with ``shard`` and ``slot``.

    ``dims`` are numeric, ``group`` is a whole number below 2^32 that rows to
    be kept together share, ``identity`` tells rows of one group apart.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    scratch, names = Scratch(rows.sparkSession), [f"c{i}" for i in range(len(keep))]
    columns = [c.alias(n) for c, n in zip(keep, names)]
    points = rows.select(
        *columns, weight.cast("bigint").alias("w"), group.cast("bigint").alias("g"), F.shiftrightunsigned(F.xxhash64(identity, F.lit("row")), 32).alias("r"),
        *[F.coalesce(c.cast("double"), F.lit(-1.0)).alias(f"d{i}") for i, c in enumerate(dims)], F.lit(0).alias("node"),
    )
    points = scratch.keep(points)
    ends = points.agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), *[f(f"d{i}").alias(f"{a}{i}") for i in range(len(dims)) for f, a in ((F.min, "lo"), (F.max, "hi"))]).first()
    scale = [max((ends[f"hi{i}"] or 0) - (ends[f"lo{i}"] or 0), 1e-300) for i in range(len(dims))]
    allowed, total = tolerance * (ends["w"] or 0) / shards, ends["n"]
    level, done = [Node(0, 0, shards)], []
    while total:
        done += [n for n in level if n.leaves == 1]
        level = [n for n in level if n.leaves > 1]
        if not level:
            break
        _spread(points, level, len(dims), scale)
        keyed = _keyed(points, level, len(dims))
        _find(keyed, level, allowed)
        full = [n for n in level if n.weight]
        if full:
            right = (F.col("k") > _case(full, lambda n: n.k, "bigint")) | ((F.col("k") == _case(full, lambda n: n.k, "bigint")) & (F.col("t") > _case(full, lambda n: n.t, "bigint")))
            moved = _keyed(points, full, len(dims)).withColumn("node", (2 * F.col("node") + F.when(right, 2).otherwise(1)).cast("int")).select(points.columns)
            rest = points.where(~F.col("node").isin([n.id for n in full]))
            new = scratch.keep(moved.unionByName(rest) if done else moved)
            scratch.drop(points)
            points = new
        level = [child for n in level for child in (Node(2 * n.id + 1, n.first, n.leaves // 2), Node(2 * n.id + 2, n.first + n.leaves // 2, n.leaves - n.leaves // 2))]
    if not total:
        return points.select(*[F.col(n) for n in names], F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    placed = points.withColumn("shard", _case(done, lambda n: n.first, "int"))
    return numbered(placed.select(*names, "shard", "r", "g"), names, total, shards)


def numbered(placed: DataFrame, names: list[str], total: int, shards: int) -> DataFrame:
    """Gapless numbers within each shard, without a task that holds a whole shard.

    Each shard is cut by a hash of the row into parts of about
    ``ROWS_PER_NUMBERING`` rows; a part starts after the rows of the parts
    before it.
    """
    parts = max(8, -(-total // (shards * ROWS_PER_NUMBERING)))
    cut = placed.withColumn("part", F.pmod(F.col("r"), F.lit(parts)).cast("int"))
    sizes = cut.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("shard", "part", before.alias("before"))
    inside = F.row_number().over(W.partitionBy("shard", "part").orderBy("r", "g", *names)) - 1
    slots = cut.withColumn("inside", inside).join(offsets, ["shard", "part"])
    return slots.select(*names, "shard", (F.col("before") + F.col("inside")).cast("bigint").alias("slot"))
