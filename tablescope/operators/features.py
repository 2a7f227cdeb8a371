"""Numeric features: median imputation, standard scaling and a 2-D projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..errors import InsufficientDataError
from ..functions.ordered import quantile_parameters
from ..functions.values import col, numeric_frame


def numeric_projection(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """Numeric columns as double, gaps and infinities as NULL, next to ``keep``."""
    if not cols:
        raise InsufficientDataError("The data set has no numeric columns.")
    return numeric_frame(df, cols, keep, finite=True)


def medians(df: DataFrame, cols: list[str], **ordering) -> dict[str, float]:
    """Exact medians of the columns that have gaps."""
    numbers = numeric_projection(df, cols)
    counts = numbers.agg(F.count(F.lit(1)).alias("n"), *[F.count(col(c)).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    gaps = [c for i, c in enumerate(cols) if counts[f"_{i}"] < counts["n"]]
    if not gaps:
        return {}
    found = quantile_parameters(numbers, gaps, {"median": 0.5}, **ordering)
    return {c: found[c]["median"] for c in gaps}


def impute_median(df: DataFrame, cols: list[str], keep: list[str] | None = None, **ordering) -> DataFrame:
    """Numeric columns with gaps filled by the exact median."""
    fill = medians(df, cols, **ordering)
    numbers = numeric_projection(df, cols, keep)
    known = {c: v for c, v in fill.items() if v is not None}
    return numbers.select(*[F.coalesce(col(c), F.lit(known[c])).alias(c) if c in known else col(c) for c in numbers.columns]) if known else numbers


@dataclass
class Spread:
    """Mean and population deviation of one column; constant columns have none."""

    mean: float | None
    deviation: float | None
    constant: bool


def spreads(numbers: DataFrame, cols: list[str]) -> dict[str, Spread]:
    """Mean and spread of every column in one pass (one row reaches the driver)."""
    cells = [
        F.struct(F.avg(col(c)).alias("m"), F.stddev_pop(col(c)).alias("s"), (F.min(col(c)) == F.max(col(c))).alias("k")).alias(f"_{i}")
        for i, c in enumerate(cols)
    ]
    row = numbers.agg(*cells).first()
    return {c: Spread(row[i]["m"], row[i]["s"], bool(row[i]["k"]) or not row[i]["s"]) for i, c in enumerate(cols)}


def scale(numbers: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """(x - mean) / population deviation; constant columns become 0."""
    stats = spreads(numbers, cols)

    def scaled(c: str) -> Column:
        s = stats[c]
        if s.mean is None:
            return col(c)
        return (F.when(col(c).isNotNull(), F.lit(0.0)) if s.constant else (col(c) - F.lit(s.mean)) / F.lit(s.deviation)).alias(c)

    return numbers.select(*[col(k) for k in keep or []], *[scaled(c) for c in cols])


def feature_frame(df: DataFrame, cols: list[str], keep: list[str] | None = None, **ordering) -> DataFrame:
    """Imputed and scaled numeric columns, next to ``keep``."""
    return scale(impute_median(df, cols, keep, **ordering), cols, keep)


def with_vectors(scaled: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with the columns gathered in a vector ``_features``; any column name will do."""
    return scaled.withColumn("_features", array_to_vector(F.array(*[col(c).cast("double") for c in cols])))


def principal_axes(scaled: DataFrame, cols: list[str]) -> list[list[float]] | None:
    """Two main axes; the sign makes the largest loading of each positive."""
    if len(cols) < 2:
        return None
    vectors = with_vectors(scaled, cols).select("_features")
    components = PCA(k=2, inputCol="_features", outputCol="_pc").fit(vectors).pc.toArray()
    axes = []
    for j in range(2):
        axis = components[:, j]
        largest = max(range(len(axis)), key=lambda i: (round(abs(axis[i]), 9), -i))
        axes.append([float(v) * (1.0 if axis[largest] >= 0 else -1.0) for v in axis])
    return axes


def project_2d(scaled: DataFrame, cols: list[str]) -> DataFrame:
    """Scaled rows with ``pc1, pc2`` (NULL when there are fewer than two columns)."""
    axes = principal_axes(scaled, cols)
    if axes is None:
        return scaled.withColumns({"pc1": F.lit(None).cast("double"), "pc2": F.lit(None).cast("double")})
    combined = [sum((col(c) * F.lit(w) for c, w in zip(cols, axis)), F.lit(0.0)) for axis in axes]
    return scaled.withColumns({"pc1": combined[0], "pc2": combined[1]})
