"""Descriptive statistics of numeric, categorical and grouped columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..functions.ordered import order_statistics
from ..functions.values import as_double, col, numeric_frame, value_text

# ---------------------------------------------------------------- fixed values
# Result columns of the descriptive table, in order.
STATISTICS = (
    "media",
    "mediana",
    "moda",
    "desviacion_estandar",
    "varianza",
    "minimo",
    "maximo",
    "rango",
    "q1",
    "q3",
    "iqr",
    "conteo",
    "faltantes",
    "asimetria",
    "curtosis",
)
# Heading of each statistic in the rounded view, in display order.
STATISTIC_HEADINGS = {
    "conteo": "Datos",
    "faltantes": "Faltantes",
    "media": "Media",
    "mediana": "Mediana",
    "moda": "Moda",
    "desviacion_estandar": "Desviación",
    "varianza": "Varianza",
    "minimo": "Mínimo",
    "q1": "Q1",
    "q3": "Q3",
    "maximo": "Máximo",
    "rango": "Rango",
    "iqr": "IQR",
    "asimetria": "Asimetría",
    "curtosis": "Curtosis",
}
# -----------------------------------------------------------------------------


def sample_skewness(x: Column) -> Column:
    """Bias-corrected skewness: NULL below three values, 0 for a constant."""
    n = F.count(x).cast("double")
    corrected = F.skewness(x) * F.sqrt(n * F.greatest(n - 1, F.lit(0.0))) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n < 3, F.lit(None).cast("double")).when(F.min(x) == F.max(x), 0.0).otherwise(corrected)


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis: NULL below four values, 0 for a constant."""
    n = F.count(x).cast("double")
    corrected = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * F.kurtosis(x) + 6)
    return F.when(n < 4, F.lit(None).cast("double")).when(F.min(x) == F.max(x), 0.0).otherwise(corrected)


def moment_columns(x: Column) -> list[Column]:
    """Every statistic that one pass of mergeable aggregates can give."""
    return [
        F.avg(x).alias("media"),
        F.sqrt(F.var_samp(x)).alias("desviacion_estandar"),
        F.var_samp(x).alias("varianza"),
        F.min(x).alias("minimo"),
        F.max(x).alias("maximo"),
        (F.max(x) - F.min(x)).alias("rango"),
        F.count(x).alias("conteo"),
        (F.count(F.lit(1)) - F.count(x)).alias("faltantes"),
        sample_skewness(x).alias("asimetria"),
        sample_kurtosis(x).alias("curtosis"),
    ]


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column, computed in a single pass over the table."""
    numbers = numeric_frame(df, cols)
    wide = numbers.agg(*[F.struct(F.lit(c).alias("variable"), *moment_columns(col(c))).alias(f"_{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))])))


def describe(df: DataFrame, cols: list[str], **ordering) -> DataFrame:
    """The fifteen statistics of each numeric column; absent columns are skipped."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        schema = "variable string, " + ", ".join(f"{s} {'bigint' if s in ('conteo', 'faltantes') else 'double'}" for s in STATISTICS)
        return df.sparkSession.createDataFrame([], schema)
    ordered = order_statistics(df, cols, {"q1": 0.25, "mediana": 0.5, "q3": 0.75}, **ordering)
    # both sides hold one row per column of the table
    joined = moments(df, cols).join(F.broadcast(ordered.withColumnRenamed("mode", "moda")), "variable", "left")
    return joined.withColumn("iqr", F.col("q3") - F.col("q1")).select("variable", *STATISTICS)


def rounded_view(statistics: DataFrame) -> DataFrame:
    """Statistics with display headings and two decimals (half to even)."""
    def shown(name: str) -> Column:
        value = F.col(name).cast("double")
        return (F.rint(value * 100) / 100).alias(STATISTIC_HEADINGS[name])

    return statistics.select(F.col("variable").alias("Variable"), *[shown(s) for s in STATISTIC_HEADINGS])


def mode_smallest(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent value per column, the smallest on ties."""
    return order_statistics(df, cols, {}).select("variable", F.col("mode").alias("moda"))


def group_moments(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Group size, mean, spread and range of each column per value of ``by``."""
    aggregates = [F.count(F.lit(1)).alias("tamano")]
    for c in cols:
        x = as_double(df, c)
        aggregates += [
            F.count(x).alias(f"conteo_{c}"),
            F.avg(x).alias(f"media_{c}"),
            F.stddev_samp(x).alias(f"desviacion_{c}"),
            F.min(x).alias(f"minimo_{c}"),
            F.max(x).alias(f"maximo_{c}"),
        ]
    return df.groupBy(col(by)).agg(*aggregates)


def category_counts(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """``(*by, variable, categoria, n)`` over the non-missing values."""
    by = by or []
    texts = df.select(*[col(b) for b in by], *[value_text(df, c).alias(f"_c{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("variable"), F.col(f"_c{i}").alias("categoria")) for i, c in enumerate(cols)]
    long = texts.select(*[col(b) for b in by], F.inline(F.array(*cells))).filter(F.col("categoria").isNotNull())
    return long.groupBy(*by, "variable", "categoria").agg(F.count(F.lit(1)).alias("n"))


def dominant_category(counts: DataFrame, by: list[str]) -> DataFrame:
    """Top value per group of counts: highest count, then smallest text."""
    return counts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("categorias_unicas"),
        F.min_by("categoria", F.struct(-F.col("n"), F.col("categoria"))).alias("categoria_mas_frecuente"),
        F.max("n").alias("frecuencia"),
        (F.max("n") / F.sum("n") * 100).alias("porcentaje"),
    )


def categorical_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values, top value and its share for each categorical column.

    Columns without any value appear with zero categories.
    """
    cols = [c for c in cols if c in df.columns]
    spark = df.sparkSession
    names = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "ord int, variable string")
    if not cols:
        return names.selectExpr(
            "ord", "variable", "0L AS categorias_unicas", "'' AS categoria_mas_frecuente", "0L AS frecuencia", "0D AS porcentaje"
        )
    found = dominant_category(category_counts(df, cols), ["variable"])
    return names.join(found, "variable", "left").select(
        "ord",
        "variable",
        F.coalesce("categorias_unicas", F.lit(0)).cast("bigint").alias("categorias_unicas"),
        "categoria_mas_frecuente",
        F.coalesce("frecuencia", F.lit(0)).cast("bigint").alias("frecuencia"),
        F.coalesce("porcentaje", F.lit(0.0)).alias("porcentaje"),
    )


def yes_no(value: Column, is_boolean: Column, upper: bool = True) -> Column:
    """True booleans read as yes/no, any other value as it is."""
    yes, no = ("Sí", "No") if upper else ("sí", "no")
    return F.when(is_boolean & (value == "true"), yes).when(is_boolean & (value == "false"), no).otherwise(value)


def categorical_view(summary: DataFrame, boolean_cols: list[str]) -> DataFrame:
    """Summary with display headings; ``boolean_cols`` are physical booleans."""
    is_boolean = F.col("variable").isin(boolean_cols) if boolean_cols else F.lit(False)
    shown = yes_no(F.col("categoria_mas_frecuente"), is_boolean)
    return summary.orderBy("ord").select(
        F.col("variable").alias("Variable"),
        F.col("categorias_unicas").alias("Categorías"),
        F.coalesce(shown, F.lit("—")).alias("Más frecuente"),
        F.col("frecuencia").alias("Repeticiones"),
        F.concat(text.fixed(F.col("porcentaje"), 1), F.lit("%")).alias("% del total"),
    )
