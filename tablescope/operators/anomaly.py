"""Unusual rows: Z-score, interquartile range, Isolation Forest and their agreement.

Detectors take the median-imputed numeric frame with a row key and add one
boolean column ``is_<method>``.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..config import AnalysisConfig
from ..functions import text
from ..functions.ordered import quantile_parameters
from ..functions.values import col
from .features import spreads
from .iforest import isolation_forest_flags

logger = logging.getLogger(__name__)

SHORT_NAMES = {"zscore": "is_zscore", "iqr": "is_iqr", "isolation_forest": "is_isolation_forest"}


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions) if conditions else F.lit(False)


def _zscore_tests(numbers: DataFrame, cols: list[str], threshold: float) -> dict[str, Column]:
    stats = spreads(numbers, cols)
    return {
        c: F.abs((col(c) - F.lit(s.mean)) / F.lit(s.deviation)) > F.lit(float(threshold))
        for c, s in stats.items()
        if not s.constant and s.mean is not None
    }


def zscore_flags(numbers: DataFrame, cols: list[str], threshold: float = 3.0) -> DataFrame:
    """Rows with any value more than ``threshold`` population deviations off the mean."""
    return numbers.withColumn("is_zscore", _any(list(_zscore_tests(numbers, cols, threshold).values())))


def zscore_counts(numbers: DataFrame, cols: list[str], threshold: float = 3.0) -> DataFrame:
    """``(variable, outliers)``; constant columns are absent."""
    tests = _zscore_tests(numbers, cols, threshold)
    if not tests:
        return numbers.sparkSession.createDataFrame([], "variable string, outliers bigint")
    wide = numbers.agg(*[F.count_if(t).alias(f"_{i}") for i, t in enumerate(tests.values())])
    cells = [F.struct(F.lit(c).alias("variable"), F.col(f"_{i}").alias("outliers")) for i, c in enumerate(tests)]
    return wide.select(F.inline(F.array(*cells)))


def iqr_limits(numbers: DataFrame, cols: list[str], multiplier: float = 1.5) -> dict[str, tuple[float, float]]:
    """Lower and upper bound per column, from exact quartiles."""
    found = quantile_parameters(numbers, cols, {"q1": 0.25, "q3": 0.75})
    limits = {}
    for c in cols:
        q1, q3 = found[c]["q1"], found[c]["q3"]
        if q1 is not None:
            limits[c] = (q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
    return limits


def iqr_bounds(numbers: DataFrame, cols: list[str], multiplier: float = 1.5) -> DataFrame:
    """``(variable, lower, upper)``."""
    rows = [(c, *map(float, b)) for c, b in iqr_limits(numbers, cols, multiplier).items()]
    return numbers.sparkSession.createDataFrame(rows, "variable string, lower double, upper double")


def iqr_flags(numbers: DataFrame, cols: list[str], multiplier: float = 1.5) -> DataFrame:
    """Rows with any value strictly outside its column's bounds."""
    limits = iqr_limits(numbers, cols, multiplier)
    tests = [(col(c) < F.lit(low)) | (col(c) > F.lit(high)) for c, (low, high) in limits.items()]
    return numbers.withColumn("is_iqr", _any(tests))


def _run_zscore(numbers, cols, key, config):
    return zscore_flags(numbers, cols, config.zscore_threshold)


def _run_iqr(numbers, cols, key, config):
    return iqr_flags(numbers, cols, config.iqr_multiplier)


def _run_forest(numbers, cols, key, config):
    return isolation_forest_flags(numbers, cols, key, config.isolation_contamination, config.random_state)


DETECTORS = {"zscore": _run_zscore, "iqr": _run_iqr, "isolation_forest": _run_forest}


def detect_anomalies(numbers: DataFrame, cols: list[str], key: str, config: AnalysisConfig | None = None) -> tuple[DataFrame, list[str]]:
    """Flags of all configured methods on one frame, and the methods that ran."""
    config = config or AnalysisConfig()
    done: list[str] = []
    for name in config.anomaly_methods:
        method = name.lower()
        if method not in DETECTORS:
            logger.warning("Unknown anomaly method skipped: %s", name)
            continue
        if method not in done:
            numbers = DETECTORS[method](numbers, cols, key, config)
            done.append(method)
    return numbers, done


def _flags(methods: list[str]) -> list[Column]:
    return [F.col(SHORT_NAMES[m]) for m in methods]


def consensus(methods: list[str]) -> Column:
    """Flagged by every method."""
    return reduce(Column.__and__, _flags(methods)) if methods else F.lit(False)


def any_signal(methods: list[str]) -> Column:
    """Flagged by at least one method."""
    return _any(_flags(methods))


def anomaly_summary(flagged: DataFrame, methods: list[str]) -> DataFrame:
    """``(ord, method, outlier_count, outlier_ratio, n_rows)``, one pass for all methods."""
    if not methods:
        return flagged.sparkSession.createDataFrame([], "n_rows bigint, ord int, method string, outlier_count bigint, outlier_ratio double")
    wide = flagged.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(SHORT_NAMES[m])).alias(m) for m in methods])
    cells = [
        F.struct(
            F.lit(i).alias("ord"), F.lit(m).alias("method"), F.col(m).alias("outlier_count"),
            F.coalesce(F.col(m) / F.nullif(F.col("n_rows"), F.lit(0)), F.lit(0.0)).alias("outlier_ratio"),
        )
        for i, m in enumerate(methods)
    ]
    return wide.select("n_rows", F.inline(F.array(*cells)))


def agreement_counts(flagged: DataFrame, methods: list[str]) -> DataFrame:
    """One row: rows flagged by all methods, by any, and in total."""
    return flagged.agg(
        F.count_if(consensus(methods)).alias("consensus"), F.count_if(any_signal(methods)).alias("any_signal"), F.count(F.lit(1)).alias("n_rows")
    )


def review_queue(flagged: DataFrame, methods: list[str], key: str) -> DataFrame:
    """Flagged rows with the methods that agree and a priority, in review order."""
    if not methods:
        none = F.lit(None).cast("string")
        return flagged.select(col(key), none.alias("metodos"), F.lit(0).alias("coincidencias"), none.alias("prioridad")).limit(0)
    hits = reduce(Column.__add__, [f.cast("int") for f in _flags(methods)])
    names = F.array_compact(F.array(*[F.when(F.col(SHORT_NAMES[m]), F.lit(text.METHOD_NAMES[m])) for m in methods]))
    return (
        flagged.filter(any_signal(methods))
        .select(
            col(key),
            F.array_join(names, ", ").alias("metodos"),
            hits.alias("coincidencias"),
            F.when(hits == len(methods), "Alta").when(hits >= 2, "Media").otherwise("Explorar").alias("prioridad"),
        )
        .orderBy(F.col("coincidencias").desc(), col(key))
    )


def scatter_classes(flagged: DataFrame, method: str, methods: list[str]) -> DataFrame:
    """Each row as normal, flagged by this method only, or by all methods."""
    own = F.col(SHORT_NAMES[method])
    return flagged.withColumn("clase", F.when(own & consensus(methods), "consensus").when(own, "method").otherwise("normal"))


def method_comparison(summary: DataFrame) -> DataFrame:
    """Chart rows: method name and percentage; the broadest method is marked."""
    widest = F.max("outlier_count").alias("m")
    # one row per method
    marked = summary.join(F.broadcast(summary.agg(widest)), F.col("outlier_count") == F.col("m"), "left")
    first = marked.groupBy().agg(F.min(F.when(F.col("m").isNotNull(), F.col("ord"))).alias("first_ord"))
    rows = marked.join(F.broadcast(first), F.col("ord") == F.col("first_ord"), "left")
    return rows.select(
        "ord", text.method_name(F.col("method")).alias("metodo"), (F.col("outlier_ratio") * 100).alias("porcentaje"),
        F.col("first_ord").isNotNull().alias("mas_amplio"),
    )
