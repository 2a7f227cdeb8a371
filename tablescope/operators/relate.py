"""Correlations between numeric columns and categorical dependencies."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import AnalysisConfig
from ..errors import UnknownMethodError
from ..functions import text
from ..functions.ordered import rank_table, with_ranks
from ..functions.values import as_double, col, numeric_frame, quoted, value_text
from ..session import cut_lineage

# ---------------------------------------------------------------- fixed values
RISING = "Cuando {first} aumenta, {second} también tiende a aumentar."
FALLING = "Cuando {first} aumenta, {second} tiende a disminuir."
# -----------------------------------------------------------------------------

PAIRS_PER_PASS = 300  # keeps one aggregate within sensible generated code
COLUMNS_PER_PASS = 60  # numeric columns of one aggregate
FEW_UNITS = 32  # brought back to their rows by one maximum each
BROADCAST_RANKS = 500_000
UNITS_PER_PASS = 400  # ranked columns of one pass
LEAST_SHARE = 1e-6  # of the squares that the variance has to be, for sums to give it
SUMS = ["n", "sa", "sb", "qa", "qb", "c"]  # of a pair: rows, values, squares, products
EMPTY_LONG = "method string, ord int, var_a string, var_b string, coefficient double, n bigint"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _coefficient(x: Column, y: Column) -> Column:
    """Pearson's r; NULL when a side is constant over the complete pairs."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))
    r = F.covar_pop(a, b) / spread
    varied = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when(varied, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def _pair_table(numbers: DataFrame, entries: list[tuple[int, str, str, str, str]], method: str) -> DataFrame:
    """One aggregate for all pairs; entries are (ord, name_a, name_b, column_a, column_b)."""
    frames = []
    for start in range(0, len(entries), PAIRS_PER_PASS):
        chunk = entries[start : start + PAIRS_PER_PASS]
        cells = []
        for i, (order, a, b, x, y) in enumerate(chunk):
            n = F.count(F.when(col(x).isNotNull() & col(y).isNotNull(), 1))
            cells.append(
                F.struct(
                    F.lit(method).alias("method"), F.lit(order).alias("ord"), F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                    _coefficient(col(x), col(y)).alias("coefficient"), n.alias("n"),
                ).alias(f"_{i}")
            )
        wide = numbers.agg(*cells)
        frames.append(wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(chunk))]))))
    return _union(frames)


def _pairs(cols: list[str], diagonal: bool) -> list[tuple[int, str, str]]:
    index = [(i, j) for i in range(len(cols)) for j in range(i if diagonal else i + 1, len(cols))]
    return [(i * len(cols) + j, cols[i], cols[j]) for i, j in index]


def pearson(df: DataFrame, cols: list[str], diagonal: bool = False) -> DataFrame:
    """Long upper triangle ``(method, ord, var_a, var_b, coefficient, n)``, pairwise complete."""
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], EMPTY_LONG)
    numbers = numeric_frame(df, cols).toDF(*[f"x{i}" for i in range(len(cols))])
    place = {c: i for i, c in enumerate(cols)}
    return _all_pairs(numbers, len(cols), [(o, a, b, place[a], place[b]) for o, a, b in _pairs(cols, diagonal)], "pearson")


def _all_pairs(numbers: DataFrame, width: int, entries: list[tuple[int, str, str, int, int]], method: str) -> DataFrame:
    """Coefficients of the columns x0, x1, ..; entries are (ord, name_a, name_b, place_a, place_b).

    Few pairs are one aggregate inside Spark.  More are matrix products: every
    task adds up, for all pairs, the sums over the rows that have both values,
    of numbers shifted by the mean of their column, so one pass serves any
    number of columns.  Pairs whose complete rows vary so little beside their
    distance from the mean that the sums cannot tell go through the aggregate.
    """
    named = lambda some: [(o, a, b, f"x{i}", f"x{j}") for o, a, b, i, j in some]
    if len(entries) <= PAIRS_PER_PASS:
        return _pair_table(numbers, named(entries), method)
    spark = numbers.sparkSession
    each = numbers.agg(*[F.struct(F.avg(x).alias("mean"), F.min(x).alias("lo"), F.max(x).alias("hi")).alias(x) for x in numbers.columns]).first()
    finite = lambda r: r["mean"] is not None and np.isfinite([r["mean"], r["lo"], r["hi"]]).all()
    known = [bool(finite(r)) for r in each]
    centre = np.array([r["mean"] if k else 0.0 for r, k in zip(each, known)])
    first, second = (np.array([e[k] for e in entries]) for k in (3, 4))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(first)))
        for batch in batches:
            for s in range(0, batch.num_rows, 4096):
                x = batch.column(0).slice(s, 4096).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - centre
                there = np.isfinite(x)
                x, m = np.where(there, x, 0.0), there.astype(float)
                sums, squares = x.T @ m, (x * x).T @ m
                total += np.stack([(m.T @ m)[first, second], sums[first, second], sums[second, first], squares[first, second], squares[second, first], (x.T @ x)[first, second]])
        columns = [pa.array(np.arange(len(first)), pa.int32()), *[pa.array(t) for t in total]]
        yield pa.RecordBatch.from_arrays(columns, names=["e", *SUMS])

    rows = numbers.select(F.array(*numbers.columns).alias("x")).mapInArrow(products, "e int, " + ", ".join(f"{t} double" for t in SUMS))
    rows = cut_lineage(rows.groupBy("e").agg(*[F.sum(t).alias(t) for t in SUMS]))  # one row per pair
    table = spark.createDataFrame([(e, o, a, b, known[i] and known[j]) for e, (o, a, b, i, j) in enumerate(entries)], "e int, ord int, var_a string, var_b string, known boolean")
    n, var_a, var_b = F.col("n"), F.col("qa") - F.col("sa") * F.col("sa") / F.col("n"), F.col("qb") - F.col("sb") * F.col("sb") / F.col("n")
    told = F.col("known") & (n > 1) & (var_a > F.col("qa") * LEAST_SHARE) & (var_b > F.col("qb") * LEAST_SHARE)
    r = (F.col("c") - F.col("sa") * F.col("sb") / n) / F.sqrt(var_a * var_b)
    rows = table.join(rows, "e", "left").withColumn("told", F.coalesce(told, F.lit(False)))
    odd = {x["e"] for x in rows.where(~F.col("told")).select("e").collect()}  # numbers of pairs
    good = rows.where("told").select(F.lit(method).alias("method"), "ord", "var_a", "var_b", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)).alias("coefficient"), n.cast("bigint").alias("n"))
    return good.unionByName(_pair_table(numbers, named([e for i, e in enumerate(entries) if i in odd]), method)) if odd else good


def _patterns(numbers: DataFrame) -> list[tuple]:
    """What is equal for two columns that have values in the same rows: their number, and sums of checksums of these rows."""
    checksum = F.xxhash64(*numbers.columns)
    halves = [F.shiftright(checksum, 40), F.shiftright(F.shiftleft(checksum, 24), 40)]
    cells = [F.struct(F.count(x), *[F.sum(F.when(F.col(x).isNotNull(), h)) for h in halves]).alias(x) for x in numbers.columns]
    return [tuple(r) for r in numbers.agg(*cells).first()]


def spearman(df: DataFrame, cols: list[str], diagonal: bool = False, partitions: int | None = None) -> DataFrame:
    """Pearson's r of tie-averaged ranks, ranked per pair on its complete rows.

    A column is ranked once for each pattern of gaps among the columns, within
    the rows that have both; without gaps that is once.  All of them are ranked
    together, one below another.  Ranks of at most ``BROADCAST_RANKS`` distinct
    values come to the rows where they lie; beyond that all are joined by value
    and brought back to their rows by one shuffle.
    """
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], EMPTY_LONG)
    numbers = numeric_frame(df, cols).toDF(*[f"x{i}" for i in range(len(cols))])
    found = _patterns(numbers)
    pattern = [found.index(p) for p in found]  # the first column of the same pattern
    place, frames = {c: i for i, c in enumerate(cols)}, []
    todo = [(o, a, b, place[a], place[b]) for o, a, b in _pairs(cols, diagonal)]
    while todo:
        units, entries = {}, []
        for o, a, b, i, j in todo:  # as many pairs as fit into one pass
            if len({(i, pattern[j]), (j, pattern[i])} - set(units)) + len(units) > UNITS_PER_PASS and entries:
                break
            entries.append((o, a, b, *[units.setdefault(u, len(units)) for u in ((i, pattern[j]), (j, pattern[i]))]))
        todo = todo[len(entries) :]
        cells = [F.struct(F.lit(v).alias("v"), F.when(F.col(f"x{p}").isNotNull(), F.col(f"x{i}")).alias("value")) for (i, p), v in units.items()]
        values = numbers.withColumn("row", F.monotonically_increasing_id()).select("row", F.inline(F.array(*cells))).where(F.col("value").isNotNull())
        table = cut_lineage(rank_table(values, partitions))
        if len(units) <= FEW_UNITS and table.count() <= BROADCAST_RANKS:
            ranks = numbers.select(*[F.when(F.col(f"x{p}").isNotNull(), F.col(f"x{i}")).alias(f"u{v}") for (i, p), v in units.items()])
            for v in range(len(units)):  # together at most BROADCAST_RANKS rows
                own = table.where(F.col("v") == v).select(F.col("value").alias(f"u{v}"), F.col("avg_rank").alias(f"x{v}"))
                ranks = ranks.join(F.broadcast(own), f"u{v}", "left")
            ranks = ranks.select(*[f"x{v}" for v in range(len(units))])
        else:
            ranked = with_ranks(values, F.col("row"), table)
            if len(units) <= FEW_UNITS:
                ranks = ranked.groupBy("row").agg(*[F.max(F.when(F.col("v") == v, F.col("avg_rank"))).alias(f"x{v}") for v in range(len(units))]).drop("row")
            else:
                ranks = ranked.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("v", "avg_rank"))).alias("r"))  # one row of the table
                ranks = ranks.select(*[F.col("r")[v].alias(f"x{v}") for v in range(len(units))])
            ranks = cut_lineage(ranks)
        frames.append(_all_pairs(ranks, len(units), entries, "spearman"))
    return _union(frames)


def _signed_pairs(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Concordant minus discordant weight over all pairs of distinct (x, y) points.

    Points are put in order of x and merged bottom-up in blocks; every level
    compares each right block with its left neighbour through sorted keys.
    """
    order = np.lexsort((y, x))
    x, weight = x[order], weight[order].astype(float)
    y = np.unique(y[order], return_inverse=True)[1].astype(np.int64)
    n, span = len(y), np.int64(y.max()) + 1 if len(y) else 1
    place = np.arange(n)
    score, width = 0.0, 1
    while width < n:
        block, right = place // (2 * width), (place // width) % 2 == 1
        left_key = block[~right] * span + y[~right]
        by_key = np.argsort(left_key, kind="stable")
        left_key = left_key[by_key]
        running = np.concatenate([[0.0], np.cumsum(weight[~right][by_key])])
        base, top = block[right] * span, (block[right] + 1) * span
        start, end = running[np.searchsorted(left_key, base)], running[np.searchsorted(left_key, top)]
        less = running[np.searchsorted(left_key, base + y[right], "left")] - start
        more = end - running[np.searchsorted(left_key, base + y[right], "right")]
        score += float(np.sum(weight[right] * (less - more)))
        width *= 2
    # pairs with equal x do not count; in this order they all added up positively
    groups = np.unique(x, return_inverse=True)[1]
    sums = np.bincount(groups, weights=weight)
    return score - float(np.sum(sums * sums) - np.sum(weight * weight)) / 2


GROUP_POINTS = 100_000  # distinct points counted in one group
CUTS = 63  # of one range of x


def kendall(df: DataFrame, cols: list[str], group_points: int = GROUP_POINTS) -> DataFrame:
    """Kendall's tau-b for every pair of columns, exact at every size.

    Equal points are counted first.  A range of x with more than
    ``group_points`` of them is cut into sub-ranges, every cut value being one
    of its own.  Points of different sub-ranges are settled by the place of
    these alone: counted by (sub-range, y), they are dealt to ranges of y, in
    which their order is counted; between two ranges of y it follows from the
    numbers of each sub-range.  Points of one sub-range are left to the next
    round, or to one group if they are few; those of one cut value are ties.
    """
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], EMPTY_LONG)
    return _union([_kendall_pair(df, order, a, b, group_points) for order, a, b in _pairs(cols, False)])


def _cut_ranges(points: DataFrame) -> DataFrame:
    """``points`` with ``sub``, their place among the cut values of their range; odd places are the cut values themselves."""
    shares = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
    cuts = points.groupBy("g").agg(F.array_distinct(F.percentile_approx("x", shares, 1000)).alias("cuts"))  # steers the work only
    below = F.size(F.filter("cuts", lambda c: c < F.col("x")))
    return points.join(cuts, "g").withColumn("sub", (2 * below + F.array_contains("cuts", F.col("x")).cast("int"))).drop("cuts")


def _score_between(points: DataFrame, group_points: int) -> float:
    """Signed pairs of points of one range of x that lie in different sub-ranges."""
    marks = points.groupBy("g", "y", "sub").agg(F.sum("n").alias("n"))  # a value of y has one row per sub-range
    marks = cut_lineage(marks)
    parts = max(1, math.ceil(marks.count() / (group_points / 4)))
    ranged = marks.repartitionByRange(parts, "g", "y").select("g", F.spark_partition_id().alias("part"), "sub", "y", "n")

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat([pd.DataFrame({"g": [], "part": [], "sub": [], "y": [], "n": []}), *batches])  # one range of y
        for (g, part), rows in held.groupby(["g", "part"]):
            score = _signed_pairs(rows["sub"].to_numpy(), rows["y"].to_numpy(), rows["n"].to_numpy())
            sums = rows.groupby("sub")["n"].sum()
            yield pd.DataFrame({"g": int(g), "part": int(part), "sub": sums.index.astype("int32"), "n": sums.to_numpy("float64"), "score": [score] + [0.0] * (len(sums) - 1)})

    counted = cut_lineage(ranged.mapInPandas(inside, "g bigint, part int, sub int, n double, score double"))
    # numbers of the sub-ranges in the ranges of y below, then those of smaller and of larger sub-ranges
    earlier = Window.partitionBy("g", "sub").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    filled = counted.groupBy("g", "part").agg(F.map_from_entries(F.collect_list(F.struct("sub", "n"))).alias("m"))  # at most 2 CUTS + 1 entries
    filled = filled.select("g", "part", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(2 * CUTS)), lambda s: F.coalesce(F.col("m")[s], F.lit(0.0)))).alias("sub", "n"))
    filled = filled.withColumn("seen", F.coalesce(F.sum("n").over(earlier), F.lit(0.0)))
    smaller = F.coalesce(F.sum("seen").over(Window.partitionBy("g", "part").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    larger = F.sum("seen").over(Window.partitionBy("g", "part")) - F.col("smaller") - F.col("seen")
    across = filled.withColumn("smaller", smaller).withColumn("larger", larger).agg(F.sum(F.col("n") * (F.col("smaller") - F.col("larger")))).first()[0]
    return float(across or 0.0) + float(counted.agg(F.sum("score")).first()[0] or 0.0)


def _score(points: DataFrame, group_points: int) -> float:
    """Concordant less discordant pairs of the weighted points ``(x, y, n)``."""
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"score": [_signed_pairs(pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["n"].to_numpy())]})

    left, total = cut_lineage(points.withColumn("g", F.lit(0).cast("bigint"))), 0.0
    while True:
        many = cut_lineage(left.groupBy("g").agg(F.count(F.lit(1)).alias("points")).where(F.col("points") > group_points).select("g"))
        few = left.join(many, "g", "left_anti")
        total += few.groupBy("g").applyInPandas(group, "score double").agg(F.sum("score")).first()[0] or 0.0
        if many.isEmpty():
            return total
        left = cut_lineage(_cut_ranges(left.join(many, "g", "left_semi")))
        total += _score_between(left, group_points)
        left = cut_lineage(left.where("sub % 2 = 0").select((F.col("g") * (2 * CUTS + 1) + F.col("sub")).alias("g"), "x", "y", "n"))


def _kendall_pair(df: DataFrame, order: int, a: str, b: str, group_points: int) -> DataFrame:
    points = numeric_frame(df, [a, b]).dropna(subset=[quoted(a), quoted(b)])
    counts = cut_lineage(points.groupBy(col(a).alias("x"), col(b).alias("y")).agg(F.count(F.lit(1)).alias("n")))
    # tie corrections come from the value counts of each column
    tied = F.coalesce(F.sum(F.col("m") * (F.col("m") - 1) / 2), F.lit(0.0))
    tx, ty = (counts.groupBy(c).agg(F.sum("n").alias("m")).agg(tied).first()[0] for c in ("x", "y"))
    n = counts.agg(F.sum("n")).first()[0] or 0
    all_pairs = n * (n - 1) / 2
    base = float(np.sqrt(all_pairs - tx) * np.sqrt(all_pairs - ty))
    tau = _score(counts, group_points) / base if base else None
    return df.sparkSession.createDataFrame([("kendall", order, a, b, tau, n)], EMPTY_LONG)


METHODS = {"pearson": pearson, "spearman": spearman, "kendall": kendall}


def correlations(df: DataFrame, cols: list[str], methods: list[str] | None = None) -> DataFrame:
    """Upper triangles of all requested methods, one below another."""
    methods = AnalysisConfig().correlation_methods if methods is None else methods
    for m in methods:
        if m not in METHODS:
            raise UnknownMethodError(f"Unknown correlation method: {m}")
    frames = [METHODS[m](df, cols).withColumn("method_ord", F.lit(i)) for i, m in enumerate(methods)]
    return _union(frames) if frames else df.sparkSession.createDataFrame([], EMPTY_LONG + ", method_ord int")


def strong_pairs(table: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs at or above the threshold with strength and direction, strongest first."""
    r = F.col("coefficient")
    return (
        table.filter(F.abs(r) >= threshold)
        .withColumn("strength", text.strength_label(r))
        .withColumn("direction", text.direction_label(r))
        .orderBy(F.abs(r).desc(), "ord")
    )


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Each unordered pair once, the earliest method winning; strongest first."""
    key = F.array_sort(F.array("var_a", "var_b"))
    first = Window.partitionBy(key).orderBy("method_ord", "ord")
    return (
        pairs.withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") == 1)
        .drop("_n")
        .orderBy(F.abs("coefficient").desc(), "method_ord", "ord")
    )


def strongest_value(table: DataFrame) -> DataFrame:
    """Largest absolute coefficient off the diagonal, per method."""
    return (
        table.filter(F.col("var_a") != F.col("var_b")).groupBy("method").agg(F.max(F.abs("coefficient")).alias("strongest"))
    )


def spearman_only(pairs: DataFrame) -> DataFrame:
    """Strong in Spearman but not in Pearson, strongest first."""
    key = F.array_sort(F.array("var_a", "var_b"))
    keyed = pairs.withColumn("_key", key)
    ours = keyed.filter(F.col("method") == "spearman")
    theirs = keyed.filter(F.col("method") == "pearson").select("_key")
    return ours.join(theirs, "_key", "left_anti").drop("_key").orderBy(F.abs("coefficient").desc(), "ord")


def full_matrix(table: DataFrame) -> DataFrame:
    """Symmetric long matrix from an upper triangle that holds its diagonal."""
    mirrored = table.filter(F.col("var_a") != F.col("var_b")).select(
        "method", F.col("var_b").alias("var_a"), F.col("var_a").alias("var_b"), "coefficient"
    )
    return table.select("method", "var_a", "var_b", "coefficient").unionByName(mirrored)


def wide_matrix(table: DataFrame, cols: list[str]) -> DataFrame:
    """One row per variable, one column per other variable."""
    return full_matrix(table).groupBy("method", "var_a").pivot("var_b", cols).agg(F.first("coefficient"))


def _category_moments(df: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """``(ci, category, xj, n, mean, spread, low, high)``: moments of each numeric column in each category, of all columns in one pass."""
    base = df.select(
        F.array(*[F.struct(F.lit(i).alias("ci"), value_text(df, c).alias("category")) for i, c in enumerate(categorical)]).alias("cells"),
        *[as_double(df, c).alias(f"x{j}") for j, c in enumerate(numeric)],
    )
    xs = [f"x{j}" for j in range(len(numeric))]
    long = base.select(F.inline("cells"), *xs).filter(F.col("category").isNotNull())

    def cell(x: str) -> Column:
        return F.struct(
            F.lit(int(x[1:])).alias("xj"), F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("spread"),
            F.min(x).alias("low"), F.max(x).alias("high"),
        ).alias(x)

    frames = []
    for start in range(0, len(xs), COLUMNS_PER_PASS):
        some = xs[start : start + COLUMNS_PER_PASS]
        groups = long.groupBy("ci", "category").agg(*[cell(x) for x in some])
        frames.append(groups.select("ci", "category", F.inline(F.array(*some))).filter(F.col("n") > 0))
    return _union(frames)


def eta_squared(df: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """Share of the variance of each numeric column explained by each category.

    One pass over the rows gives the moments of every (category, column); the
    totals of each pair of columns follow from them.  NULL below two
    categories, below three rows or without variance.
    """
    groups = cut_lineage(_category_moments(df, categorical, numeric))
    totals = groups.groupBy("ci", "xj").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand_mean"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("categories"),
        F.sum("spread").alias("ss_within"), (F.min("low") == F.max("high")).alias("constant"),
    )
    apart = F.col("mean") - F.col("grand_mean")
    # totals hold one row per pair of columns
    between = groups.join(F.broadcast(totals.select("ci", "xj", "grand_mean")), ["ci", "xj"]).groupBy("ci", "xj").agg(F.sum(F.col("n") * apart * apart).alias("ss_between"))
    valid = (F.col("categories") >= 2) & (F.col("rows") >= 3) & ~F.col("constant")
    return between.join(totals, ["ci", "xj"]).select(
        (F.col("ci") * len(numeric) + F.col("xj")).alias("ord"),
        F.element_at(F.array(*[F.lit(c) for c in categorical]), F.col("ci") + 1).alias("categorical"),
        F.element_at(F.array(*[F.lit(c) for c in numeric]), F.col("xj") + 1).alias("numeric"),
        F.when(valid, F.col("ss_between") / F.nullif(F.col("ss_between") + F.col("ss_within"), F.lit(0.0))).alias("eta_squared"),
    )


def dependencies(df: DataFrame, categorical: list[str], numeric: list[str], threshold: float = 0.14) -> DataFrame:
    """Pairs whose eta squared reaches the threshold, strongest first."""
    if not categorical or not numeric:
        return df.sparkSession.createDataFrame([], "ord int, categorical string, numeric string, eta_squared double")
    found = eta_squared(df, categorical, numeric).filter(F.col("eta_squared") >= threshold)
    return found.orderBy(F.col("eta_squared").desc(), "ord")


def dependency_feed(table: DataFrame) -> DataFrame:
    """Chart rows: readable label, percentage and association label."""
    return table.select(
        F.concat(text.titled(F.col("categorical")), F.lit(" → "), text.titled(F.col("numeric"))).alias("etiqueta"),
        (F.col("eta_squared") * 100).alias("porcentaje"),
        text.association_label(F.col("eta_squared")).alias("asociacion"),
    )


def relationship_sentences(pairs: DataFrame) -> DataFrame:
    """Strong pairs with an everyday sentence about the sign."""
    first, second = F.lower(text.titled(F.col("var_a"))), F.lower(text.titled(F.col("var_b")))
    rising, falling = (text.filled(t, first=first, second=second) for t in (RISING, FALLING))
    return pairs.withColumn("sentence", F.when(F.col("coefficient") >= 0, rising).otherwise(falling))
