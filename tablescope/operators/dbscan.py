"""DBSCAN on a grid, with the labels a scan in row order would give.

Cells are small enough that any two of their points are neighbours.  A cell
with ``min_samples`` points or more is therefore one node of the graph of core
points, however many rows it holds, and no pairs are formed inside it.  Only
points of the other cells, fewer than ``min_samples`` in each, are compared
with the points around them, so the number of comparisons grows linearly.
Whether two full cells touch is settled by comparing the boxes around ever
smaller parts of them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.graph import connected_components
from ..functions.ordered import dense_index, rank_table
from ..functions.skew import SALTS, hot_key_hashes, is_hot, lookup, salted_join
from ..functions.values import col
from ..session import cut_lineage
from .blocks import LEAF_BOXES, LEAF_ROWS, kth_distances, near_boxes

DEFAULT_EPS = 0.5
KNEE_RANGES = 100
MAX_HALVINGS = 40
STEPS_PER_ROW = 64  # comparisons of points per row of the table
MAX_STEPS = 1e8  # and for one pair of cells


# ------------------------------------------------------------------ k-distance
def k_distances(scaled: DataFrame, cols: list[str], key: str, k: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``(key, k_distance)`` for every row: distance to the k-th nearest row, itself included."""
    return kth_distances(scaled, cols, key, k, leaf_rows)


def knee_value(curve: DataFrame, value: str = "k_distance") -> float:
    """Value of an ascending curve farthest from the line through its ends, the smaller on ties.

    Of a run of equal values only the first and last place can be farthest, so
    values are counted first, and dealt to ranges of about equal numbers.
    """
    values = curve.select(F.lit(0).alias("v"), F.col(value).cast("double").alias("value"))
    places = cut_lineage(rank_table(values, KNEE_RANGES))
    ends = places.agg(F.min("value"), F.max("value"), F.sum("n")).first()
    low, high, n = ends[0], ends[1], ends[2] or 0
    if n < 3:
        return float(high) if n else DEFAULT_EPS
    off = [
        F.struct(F.abs(low + (high - low) * p / (n - 1) - F.col("value")).alias("off"), (-p).alias("p"), F.col("value").alias("value"))
        for p in (F.col("before"), F.col("before") + F.col("n") - 1)
    ]
    return float(places.agg(F.max(F.greatest(*off)).alias("x")).first()["x"]["value"])


def estimate_eps(scaled: DataFrame, cols: list[str], key: str, min_samples: int = 5, leaf_rows: int = LEAF_ROWS) -> float:
    """Radius at the knee of the k-distance curve of all rows."""
    n_rows = scaled.agg(F.count(F.lit(1))).first()[0]
    k = min(min_samples, n_rows - 1)
    if k < 1:
        return DEFAULT_EPS
    eps = knee_value(k_distances(scaled, cols, key, k, leaf_rows))
    return eps if eps > 0 else DEFAULT_EPS


# ------------------------------------------------------------------------ grid
def _box(d: int) -> list[Column]:
    return [f(F.col(f"x{i}")).alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))]


def _box_struct(d: int) -> Column:
    return F.struct(*[F.col(f"{n}{i}") for i in range(d) for n in ("lo", "hi")]).alias("box")


def _root_of_squares(terms: list[Column]) -> Column:
    total = terms[0] * terms[0]
    for t in terms[1:]:
        total = total + t * t
    return F.sqrt(total)


def _gap(a: str, b: str, d: int) -> Column:
    """Smallest distance between two boxes; never above that of two of their points."""
    return _root_of_squares(
        [F.greatest(F.lit(0.0), F.col(f"{a}.lo{i}") - F.col(f"{b}.hi{i}"), F.col(f"{b}.lo{i}") - F.col(f"{a}.hi{i}")) for i in range(d)]
    )


def _reach(a: str, b: str, d: int) -> Column:
    """Largest distance between two boxes; never below that of two of their points."""
    return _root_of_squares(
        [F.greatest(F.col(f"{a}.hi{i}") - F.col(f"{b}.lo{i}"), F.col(f"{b}.hi{i}") - F.col(f"{a}.lo{i}")) for i in range(d)]
    )


def _point_box(d: int) -> Column:
    """A point as a box without extent."""
    return F.struct(*[F.col(f"x{i}").alias(f"{n}{i}") for i in range(d) for n in ("lo", "hi")])


def _part(d: int, halvings: int) -> Column:
    """Place of a point inside its cell after so many halvings of every axis."""
    if halvings == 0:
        return F.array().cast("array<bigint>")
    return F.array(*[F.floor((F.col(f"u{i}") - F.floor(f"u{i}")) * F.lit(float(2**halvings))).cast("bigint") for i in range(d)])


def _touching_boxes(pairs: DataFrame, points: DataFrame, n_rows: int, d: int, eps: float, hot: list[int]) -> DataFrame:
    """Pairs ``(a, b)`` of full cells that hold points within ``eps`` of each other.

    ``pairs`` has the cells ``a, b``, their boxes and row counts.  Boxes that
    lie wholly within ``eps`` connect their cells, boxes farther apart are
    dropped, and the rest is halved on every axis and looked at again, until
    comparing the points left costs no more than a few steps per row.
    """
    whole = _part(d, 0)
    judged = cut_lineage(
        pairs.select("a", "b", whole.alias("a_part"), whole.alias("b_part"), "a_n", "b_n", (_reach("a_box", "b_box", d) <= eps).alias("joined"))
    )
    found = []
    for level in range(MAX_HALVINGS + 1):
        done = judged.filter("joined").select("a", "b").distinct()
        found.append(done)
        still = judged.filter(~F.col("joined")).drop("joined")
        if level:  # one part of a pair may have settled it
            still = cut_lineage(still.join(done, ["a", "b"], "left_anti"))
        steps = F.col("a_n").cast("double") * F.col("b_n")
        cost = still.agg(F.sum(steps).alias("all"), F.max(steps).alias("one")).first()
        if cost["all"] is None:
            break
        side = lambda s: still.select(F.struct(F.col(s).alias("cell"), F.col(f"{s}_part").alias("part")).alias("slot"))
        wanted = side("a").unionByName(side("b")).distinct()
        inside = _semi(points.withColumn("slot", F.struct("cell", _part(d, level).alias("part"))), wanted, hot)
        if (cost["all"] <= STEPS_PER_ROW * n_rows and cost["one"] <= MAX_STEPS) or level == MAX_HALVINGS:
            found.append(_compare_points(still, inside, d, eps))
            break
        boxes = inside.groupBy("slot", _part(d, level + 1).alias("new")).agg(F.count(F.lit(1)).alias("n"), *_box(d))
        boxes = cut_lineage(boxes.select("slot", "new", "n", _box_struct(d)))
        sides = {
            s: boxes.select(
                F.col("slot.cell").alias(s), F.col("slot.part").alias(f"{s}_part"), F.col("new").alias(f"{s}_new"),
                F.col("n").alias(f"{s}_n"), F.col("box").alias(f"{s}_box"),
            )
            for s in "ab"
        }
        # at most 2**d parts on either side of a pair
        finer = still.select("a", "b", "a_part", "b_part").join(sides["a"], ["a", "a_part"]).join(sides["b"], ["b", "b_part"])
        finer = finer.filter(_gap("a_box", "b_box", d) <= eps)
        judged = cut_lineage(
            finer.select(
                "a", "b", F.col("a_new").alias("a_part"), F.col("b_new").alias("b_part"), "a_n", "b_n", (_reach("a_box", "b_box", d) <= eps).alias("joined")
            )
        )
    return reduce(DataFrame.unionByName, found)


def _semi(inside: DataFrame, wanted: DataFrame, hot: list[int]) -> DataFrame:
    """Points whose slot is wanted; those of hot cells are spread over salts."""
    if not hot:
        return inside.join(wanted, "slot", "left_semi")
    is_hot_slot = is_hot(F.col("slot.cell"), hot)
    salt = F.when(is_hot_slot, F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.when(is_hot_slot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return inside.withColumn("_salt", salt).join(wanted.withColumn("_salt", F.explode(every)), ["slot", "_salt"], "left_semi").drop("_salt")


def _compare_points(still: DataFrame, inside: DataFrame, d: int, eps: float) -> DataFrame:
    """Settle the open pairs by the distinct positions of their points."""
    spots = inside.select("slot", _point_box(d).alias("box")).distinct()
    side = lambda s: spots.select(F.col("slot.cell").alias(s), F.col("slot.part").alias(f"{s}_part"), F.col("box").alias(f"{s}_box"))
    met = still.select("a", "b", "a_part", "b_part").join(side("a"), ["a", "a_part"]).join(side("b"), ["b", "b_part"])
    return met.filter(_reach("a_box", "b_box", d) <= eps).select("a", "b").distinct()


def dbscan(scaled: DataFrame, cols: list[str], key: str, eps: float, min_samples: int = 5, leaf_rows: int = LEAF_BOXES) -> DataFrame:
    """``(key, label)`` for every row; -1 marks noise, clusters count from 0."""
    d = len(cols)
    if not isinstance(scaled.schema[key].dataType, T.IntegralType):  # the graph below is one of whole numbers
        numbers = dense_index(scaled, key, "_number")
        rows = scaled.select(col(key).alias("_key"), *[col(c) for c in cols]).join(numbers.select(col(key).alias("_key"), "_number"), "_key")
        found = dbscan(rows, cols, "_number", eps, min_samples, leaf_rows)
        return found.join(numbers, "_number").select(col(key), "label")
    side = eps / math.sqrt(d) * (1 - 1e-9)
    names = [f"x{i}" for i in range(d)]
    points = scaled.select(col(key).alias("id"), *[col(c).alias(n) for c, n in zip(cols, names)])
    points = points.withColumns({f"u{i}": F.col(f"x{i}") / F.lit(side) for i in range(d)})
    points = points.withColumn("cell", F.array(*[F.floor(f"u{i}").cast("bigint") for i in range(d)]))
    cells = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), *_box(d))
    cells = cells.select("cell", "n", "first_id", _box_struct(d))
    cells = cut_lineage(cells.withColumn("full", (F.col("n") >= min_samples) & (_reach("box", "box", d) <= eps)))
    hot = hot_key_hashes(cells, "cell", "n")

    # neighbouring cells, found by descending a tree over their boxes
    near = near_boxes(cells.select(F.col("first_id").alias("id"), "box.*"), d, eps, leaf_rows)
    sides = {
        s: cells.select(
            F.col("first_id").alias(f"{s}_id"), F.col("cell").alias(s), F.col("n").alias(f"{s}_n"), F.col("full").alias(f"{s}_full"), F.col("box").alias(f"{s}_box")
        )
        for s in "ab"
    }
    near = cut_lineage(near.select(F.col("a").alias("a_id"), F.col("b").alias("b_id")).join(sides["a"], "a_id").join(sides["b"], "b_id").drop("a_id"))

    # edges between full cells
    full_pairs = near.filter(F.col("a_full") & F.col("b_full") & (F.col("a") < F.col("b")))
    n_rows = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    touching = _touching_boxes(full_pairs.select("a", "b", "a_box", "b_box", "a_n", "b_n"), points, n_rows, d, eps, hot)
    ids = cells.filter("full").select("cell", "first_id")
    full_edges = (
        touching.join(ids.select(F.col("cell").alias("a"), F.col("first_id").alias("ia")), "a")
        .join(ids.select(F.col("cell").alias("b"), F.col("first_id").alias("ib")), "b")
        .select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    )

    # points of the other cells, each with the cells around it
    full_hot = is_hot(F.col("cell"), hot)
    sparse = points.filter(~full_hot) if hot else points
    sparse = sparse.join(cells.filter(~F.col("full")).select("cell"), "cell", "left_semi")
    if hot:  # a hot cell that is not full is kept whole
        odd = cells.filter(~F.col("full") & is_hot(F.col("cell"), hot)).select("cell")
        sparse = sparse.unionByName(points.filter(full_hot).join(F.broadcast(odd), "cell", "left_semi"))
    around = (
        sparse.select("id", _point_box(d).alias("p"), F.col("cell").alias("a"))
        .join(near.filter(~F.col("a_full")).select("a", "b", "b_n", "b_id", "b_full", "b_box"), "a")
        .filter(_gap("p", "b_box", d) <= eps)
    )
    wholly = F.col("b_full") & (_reach("p", "b_box", d) <= eps)
    whole_cells = around.filter(wholly).select("id", F.col("b_id").alias("other"), F.lit(True).alias("other_full"), F.col("b_n").alias("n"))
    asked = around.filter(~wholly).select(F.col("b").alias("cell"), F.col("id").alias("asker"), "p", "b_id", "b_full")
    met = salted_join(points.select("id", "cell", _point_box(d).alias("q")), asked, "cell", hot, F.col("id"))
    met = met.filter(_reach("p", "q", d) <= eps)
    counted = met.groupBy(
        F.col("asker").alias("id"), F.when(F.col("b_full"), F.col("b_id")).otherwise(F.col("id")).alias("other"), F.col("b_full").alias("other_full")
    ).agg(F.count(F.lit(1)).alias("n"))
    links = cut_lineage(whole_cells.unionByName(counted))

    # core points outside full cells, and the graph of all core nodes
    core = cut_lineage(links.groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_samples).select("id"))
    core_links = links.join(core, "id", "left_semi")
    to_full = core_links.filter("other_full").select(F.col("id").alias("a"), F.col("other").alias("b"))
    to_core = core_links.filter(~F.col("other_full") & (F.col("id") < F.col("other"))).join(core.select(F.col("id").alias("other")), "other", "left_semi")
    edges = full_edges.unionByName(to_full).unionByName(to_core.select(F.col("id").alias("a"), F.col("other").alias("b")))
    nodes = ids.select(F.col("first_id").alias("node")).unionByName(core.select(F.col("id").alias("node")))
    components = connected_components(nodes, edges)
    numbers = dense_index(components, "root", "label")
    labels = cut_lineage(lookup(components, "root", numbers, "node", "inner").select("node", F.col("label").cast("int").alias("label")))

    # every row takes the label of its full cell, of itself, or of its first cluster
    cell_labels = ids.join(labels, ids["first_id"] == labels["node"]).select("cell", F.col("label").alias("cell_label"))
    known = labels.select(F.col("node").alias("other"), F.col("label").alias("other_label"))
    own = labels.select(F.col("node").alias("id"), F.col("label").alias("own_label"))
    border = lookup(links.join(core, "id", "left_anti"), "other", known, "id", "inner").groupBy("id").agg(F.min("other_label").alias("own_label"))
    point_labels = core.join(own, "id").unionByName(border)
    total = salted_join(points.select("id", "cell"), cell_labels, "cell", hot, F.col("id"), "left")
    total = total.join(point_labels, "id", "left")
    return total.select(F.col("id").alias(key), F.coalesce("cell_label", "own_label", F.lit(-1)).cast("int").alias("label"))
