"""Exact order statistics without sorting a column.

Quantiles are selected digit by digit.  The first digit of a number is its
sign and its place on a logarithmic scale; the next ones divide what lies
between the smallest and the largest value of a bucket into equal steps.  Both
keep the order, so a pass that counts the rows of each bucket, for all columns
and quantiles at once, tells which bucket holds a wanted place.  Only the rows
of such buckets are looked at again, until a bucket holds a single value,
however many rows have it, or few rows, which are counted by value.  What
reaches the driver is one row per wanted place.

Ranks need all values in order: values are counted, range-partitioned and
summed up inside the partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .values import col, numeric_frame

ROWS_PER_BUCKET = 500_000  # a bucket of at most so many rows is settled by counting its values
STEPS_PER_OCTAVE = 16
STEPS = 65_536  # of the later digits
INFINITE = float("inf")
BEYOND = 40_000  # first digit of infinity; finite numbers stay below
HOT_SHARE = 64  # a value held by more than 1/64 of the rows is hot: at most 64 in a column
SPREAD = 1024


def long_values(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """``(*keep, v, value)``: the present values of all columns below each other, ``v`` being the place of the column."""
    keep = keep or []
    numbers = numeric_frame(df, cols, keep).toDF(*keep, *[f"_{i}" for i in range(len(cols))])
    cells = [F.struct(F.lit(i).alias("v"), F.col(f"_{i}").alias("value")) for i in range(len(cols))]
    return numbers.select(*[col(k) for k in keep], F.inline(F.array(*cells))).where(F.col("value").isNotNull())


# ------------------------------------------------------------------- selection
def _first_digit(x: Column) -> Column:
    """Sign and logarithm in whole steps; never falls as the number grows."""
    steps = 1 + F.floor((F.log2(F.abs(x)) + 1075) * STEPS_PER_OCTAVE)
    size = F.when(F.abs(x) == INFINITE, F.lit(BEYOND)).otherwise(steps)
    return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * size)


def _buckets(values: DataFrame, group: str, digit: Column) -> DataFrame:
    """Rows, smallest and largest value of each bucket, and the rows of its group before it."""
    counts = values.groupBy(F.col(group).alias("g"), digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    # a group has at most STEPS, twice BEYOND or rows_per_bucket digits
    return counts.withColumn("before", F.sum("n").over(Window.partitionBy("g").orderBy("digit")) - F.col("n"))


def _places(total: Column, probabilities: list[float]) -> Column:
    """The places, counted from 0, that the quantiles of ``total`` values lie between."""
    lower = [F.floor((total - 1) * F.lit(float(p))) for p in probabilities]
    return F.array_distinct(F.array(*lower, *[F.least(x + 1, total - 1) for x in lower]))


def selected(df: DataFrame, cols: list[str], probabilities: list[float], rows_per_bucket: int = ROWS_PER_BUCKET) -> list[tuple[int, dict[int, float]]]:
    """Per column the number of its values, and those at the places of :func:`_places`."""
    spark, values = df.sparkSession, long_values(df, cols)
    found: list[tuple[int, dict[int, float]]] = [(0, {}) for _ in cols]
    if not probabilities:
        return found
    counts = _buckets(values, "v", _first_digit(F.col("value"))).withColumn("total", F.sum("n").over(Window.partitionBy("g")))
    counts = counts.withColumn("place", F.explode(_places(F.col("total"), probabilities)))
    inside = (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n"))
    crossed = []
    for r in counts.where(inside).collect():  # two places a quantile and column
        found[r["g"]] = (r["total"], found[r["g"]][1])
        crossed.append((r["g"], r["place"], r["before"], r["n"], r["lo"], r["hi"]))
    while True:
        open_: dict[tuple, list[int]] = {}
        for v, place, before, n, lo, hi in crossed:
            if lo == hi:
                found[v][1][place] = lo
            else:
                open_.setdefault((v, before, n, lo, hi), []).append(place)
        if not open_:
            return found
        ranges = [(g, v, lo, hi, n <= rows_per_bucket) for g, (v, _, n, lo, hi) in enumerate(open_)]
        sought = [(g, place - before) for g, ((_, before, *_), places) in enumerate(open_.items()) for place in places]
        table = F.broadcast(spark.createDataFrame(ranges, "g int, v int, low double, high double, few boolean"))
        within = values.join(table, "v").where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
        step = F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * STEPS), F.lit(STEPS - 1))
        counts = _buckets(within, "g", F.when(F.col("few"), F.col("value")).otherwise(step))
        counts = counts.join(F.broadcast(spark.createDataFrame(sought, "g int, place bigint")), "g")
        owners = list(open_)
        crossed = [(owners[r["g"]][0], owners[r["g"]][1] + r["place"], owners[r["g"]][1] + r["before"], r["n"], r["lo"], r["hi"]) for r in counts.where(inside).collect()]


def _between(total: int, values: dict[int, float], probability: float) -> float | None:
    """The linearly interpolated quantile."""
    if not total:
        return None
    position = (total - 1) * float(probability)
    below = math.floor(position)
    low, high, share = values[below], values[min(below + 1, total - 1)], position - below
    return low if share == 0 or low == high else low + (high - low) * share


def quantile_parameters(df: DataFrame, cols: list[str], probabilities: dict[str, float], **kwargs) -> dict[str, dict[str, float]]:
    """The quantiles as plain numbers, one row per column; None for a column without values."""
    found = selected(df, cols, list(probabilities.values()), **kwargs) if cols else []
    return {c: {name: _between(*f, p) for name, p in probabilities.items()} for c, f in zip(cols, found)}


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(v, mode)``: the most frequent value of each column, the smallest on ties."""
    counts = long_values(df, cols).groupBy("v", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("v").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def order_statistics(df: DataFrame, cols: list[str], probabilities: dict[str, float], **kwargs) -> DataFrame:
    """Quantiles and mode (smallest on ties) per column with values: ``(variable, <names>, mode)``."""
    found = quantile_parameters(df, cols, probabilities, **kwargs)
    rows = [(i, c, *found[c].values()) for i, c in enumerate(cols)]
    fields = "".join(f", {name} double" for name in probabilities)
    table = df.sparkSession.createDataFrame(rows, f"v int, variable string{fields}")  # one row per column
    return modes(df, cols).join(F.broadcast(table), "v").select("variable", *probabilities, "mode")


# ----------------------------------------------------------------------- ranks
def rank_table(values: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(v, value, n, before, total, avg_rank)`` for every distinct value of ``(.., v, value)``.

    ``before`` counts the smaller rows of the same ``v`` and ``avg_rank`` is
    the tie-averaged rank.  Counted values are range-partitioned, so a
    partition holds a bounded part of the distinct values of any column.
    """
    counts = values.groupBy("v", "value").agg(F.count(F.lit(1)).alias("n"))
    by = [F.col("v"), F.col("value")]
    ranged = counts.repartitionByRange(partitions, *by) if partitions else counts.repartitionByRange(*by)
    placed = cut_lineage(ranged.withColumn("part", F.spark_partition_id()))
    sums = placed.groupBy("v", "part").agg(F.sum("n").alias("in_part"))  # one row per partition and column it reaches
    every = Window.partitionBy("v")
    offsets = sums.select("v", "part", (F.sum("in_part").over(every.orderBy("part")) - F.col("in_part")).alias("offset"), F.sum("in_part").over(every).alias("total"))
    inside = F.sum("n").over(Window.partitionBy("v", "part").orderBy("value")) - F.col("n")
    ranked = placed.withColumn("inside", inside).join(F.broadcast(offsets), ["v", "part"]).withColumn("before", F.col("offset") + F.col("inside"))
    return ranked.select("v", "value", "n", "before", "total", (F.col("before") + (F.col("n") + 1) / 2).alias("avg_rank"))


def with_ranks(values: DataFrame, spread: Column, table: DataFrame) -> DataFrame:
    """Rows of ``(.., v, value)`` with ``avg_rank`` among the rows of the same ``v``.

    One join by value with ``table``, a written :func:`rank_table`, for all
    columns.  The few hot values are broadcast; their rows go to keys of their
    own, dealt by ``spread``, in the join of the others.
    """
    hot = table.where(F.col("n") * HOT_SHARE > F.col("total")).select("v", "value", F.col("avg_rank").alias("hot_rank"))  # at most HOT_SHARE a column
    rest = table.where(F.col("n") * HOT_SHARE <= F.col("total")).select(F.col("v").alias("key"), "value", "avg_rank")
    rows = values.join(F.broadcast(hot), ["v", "value"], "left")
    apart = -1 - F.pmod(F.xxhash64(spread), F.lit(SPREAD)).cast("int")
    rows = rows.withColumn("key", F.when(F.col("hot_rank").isNotNull(), apart).otherwise(F.col("v"))).join(rest, ["key", "value"], "left")
    return rows.withColumn("avg_rank", F.coalesce("hot_rank", "avg_rank")).drop("key", "hot_rank")


def dense_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of ``column`` numbered from 0 in ascending order.

    Values are range-partitioned and written with their partition and place in
    it; only one row count per partition reaches the driver.
    """
    ranged = df.select(col(column)).distinct().repartitionByRange(col(column)).sortWithinPartitions(col(column))
    placed = cut_lineage(ranged.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumns({"_part": F.shiftright("_id", 33).cast("int"), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)})
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    offsets, seen = [], 0
    for r in counts:
        offsets.append((r["_part"], seen))
        seen += r["n"]
    # one row per partition
    table = df.sparkSession.createDataFrame(offsets, "_part int, _offset bigint")
    return placed.join(F.broadcast(table), "_part").select(col(column), (F.col("_offset") + F.col("_at")).alias(name))
