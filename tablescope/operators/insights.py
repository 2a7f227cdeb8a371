"""Findings as sentences: one table ``(ord, category, severity, message)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text

# ---------------------------------------------------------------- fixed values
# Order of the categories, the thresholds that raise a warning and the wording
# of every sentence.
CATEGORIES = ("dataset", "missing", "correlation", "dependency", "clustering", "anomaly")
MISSING_WARNING = 0.2
ANOMALY_WARNING = 0.1
MAX_RECOMMENDATIONS = 5

DATASET = "El conjunto de datos contiene {rows} registros y {columns} variables ({numeric} numéricas, {categorical} categóricas, {datetime} temporales)."
MISSING = "La variable '{name}' tiene {percent}% de valores faltantes."
CORRELATION = "Existe una correlación {strength} {direction} (r={r}) entre '{a}' y '{b}'."
DEPENDENCY = "La variable '{categorical}' explica un {percent}% de la variación en '{numeric}'."
CLUSTERS = "Se detectaron {count} agrupaciones principales usando {algorithm} sobre las variables: {features}."
CLUSTER_QUALITY = "La calidad de la agrupación es {quality} (silhouette={score})."
ANOMALY = "El método {method} detectó un {percent}% de registros con valores atípicos ({count} de {rows})."

SUMMARY_SIZE = "El análisis incluye {rows} registros y {columns} variables."
SUMMARY_RELATION = "La relación numérica más marcada aparece entre {a} y {b} ({r}), que tienden a moverse {direction}."
SAME_DIRECTION = "en el mismo sentido"
OPPOSITE_DIRECTION = "en sentido contrario"
SUMMARY_SEGMENTS = "Se encontraron {count} segmentos mediante {algorithm}, con separación {quality}."
SUMMARY_ANOMALIES = (
    "{any_signal} registros recibieron al menos una señal de comportamiento inusual y {consensus} coincidieron en todos los métodos."
)

ADVISE_RELATION = "Revisar {a} junto con {b} en futuras comparaciones, sin asumir causalidad."
ADVISE_DEPENDENCY = "Comparar {numeric} por las categorías de {categorical} antes de usar un promedio general."
ADVISE_SEGMENTS = "Comparar los indicadores de cada segmento para identificar sus diferencias principales."
ADVISE_ANOMALIES = (
    "Revisar primero los {consensus} registros señalados por todos los detectores y confirmar su contexto antes de corregirlos o eliminarlos."
)
ADVISE_ALWAYS = "Interpretar los resultados según el contexto del conjunto de datos y documentar las conclusiones obtenidas."
# -----------------------------------------------------------------------------


def _finding(category: str, order: Column, message: Column, severity: Column | str = "info") -> list[Column]:
    level = severity if isinstance(severity, Column) else F.lit(severity)
    return [
        F.lit(CATEGORIES.index(category)).alias("group_ord"), order.cast("bigint").alias("row_ord"), F.lit(category).alias("category"),
        level.alias("severity"), message.alias("message"),
    ]


def dataset_insight(profile: DataFrame) -> DataFrame:
    counted = profile.agg(
        F.max("n_rows").alias("r"), F.count(F.lit(1)).alias("c"),
        *[F.count_if(F.col("logical_type") == k).alias(k) for k in ("numeric", "categorical", "datetime")],
    )
    kinds = {k: F.col(k) for k in ("numeric", "categorical", "datetime")}
    message = text.filled(DATASET, rows=F.col("r"), columns=F.col("c"), **kinds)
    return counted.select(*_finding("dataset", F.lit(0), message))


def missing_insights(profile: DataFrame) -> DataFrame:
    ratio = F.col("missing_ratio")
    message = text.filled(MISSING, name=F.col("name"), percent=text.fixed(ratio * 100, 1))
    severity = F.when(ratio > MISSING_WARNING, "warning").otherwise("info")
    return profile.filter(ratio > 0).select(*_finding("missing", F.col("ord"), message, severity))


def correlation_insights(pairs: DataFrame) -> DataFrame:
    """``pairs``: strong pairs of all methods, each unordered pair once."""
    message = text.filled(
        CORRELATION, strength=F.col("strength"), direction=F.col("direction"), r=text.fixed(F.col("coefficient"), 2), a=F.col("var_a"), b=F.col("var_b")
    )
    # first method first, strongest first inside a method; one row per pair of columns
    order = F.row_number().over(Window.partitionBy().orderBy("method_ord", F.abs("coefficient").desc(), "ord"))
    return pairs.select(*_finding("correlation", order, message))


def dependency_insights(dependencies: DataFrame) -> DataFrame:
    message = text.filled(
        DEPENDENCY, categorical=F.col("categorical"), percent=text.fixed(F.col("eta_squared") * 100, 0), numeric=F.col("numeric")
    )
    order = F.row_number().over(Window.partitionBy().orderBy(F.col("eta_squared").desc(), "ord"))
    return dependencies.select(*_finding("dependency", order, message))


def clustering_summary(spark, clustering) -> DataFrame:
    """The figures of a clustering run as a one-row table."""
    schema = "algorithm string, n_clusters int, features array<string>, silhouette double, silhouette_rows int, calidad string"
    row = [] if clustering is None else [
        (clustering.algorithm, clustering.n_clusters, clustering.features, clustering.silhouette, clustering.silhouette_rows)
    ]
    table = spark.createDataFrame(row, schema.rsplit(",", 1)[0])
    return table.withColumn("calidad", text.quality_label(F.col("silhouette")))


def clustering_insights(summary: DataFrame) -> DataFrame:
    found = summary.filter(F.col("n_clusters") > 0)
    count = text.filled(CLUSTERS, count=F.col("n_clusters"), algorithm=F.upper("algorithm"), features=F.array_join("features", ", "))
    quality = text.filled(CLUSTER_QUALITY, quality=F.lower("calidad"), score=text.fixed(F.col("silhouette"), 2))
    first = found.select(*_finding("clustering", F.lit(0), count))
    return first.unionByName(found.filter(F.col("silhouette").isNotNull()).select(*_finding("clustering", F.lit(1), quality)))


def anomaly_insights(summary: DataFrame) -> DataFrame:
    ratio = F.col("outlier_ratio")
    message = text.filled(
        ANOMALY, method=F.upper("method"), percent=text.fixed(ratio * 100, 1), count=F.col("outlier_count"), rows=F.col("n_rows")
    )
    severity = F.when(ratio > ANOMALY_WARNING, "warning").otherwise("info")
    return summary.select(*_finding("anomaly", F.col("ord"), message, severity))


def assemble(parts: list[DataFrame]) -> DataFrame:
    """All findings in reading order; a handful of rows per column of the data."""
    table = reduce(DataFrame.unionByName, parts)
    order = F.row_number().over(Window.partitionBy().orderBy("group_ord", "row_ord"))
    return table.select(order.alias("ord"), "category", "severity", "message").orderBy("ord")


# ------------------------------------------------------------ summary and advice
def _lower_name(name: str) -> Column:
    return F.lower(text.capitalised(F.col(name)))


def _top(table: DataFrame, order: list[Column], text_column: Column) -> DataFrame:
    return table.orderBy(*order).limit(1).select(text_column.alias("message"))


def _strongest(pairs: DataFrame) -> list[Column]:
    return [F.abs("coefficient").desc(), F.col("method_ord"), F.col("ord")]


def executive_summary(profile: DataFrame, pairs: DataFrame, clustering: DataFrame, agreement: DataFrame | None) -> DataFrame:
    """One row ``summary``; each input table adds a sentence when it has rows."""
    size = profile.agg(F.max("n_rows").alias("r"), F.count(F.lit(1)).alias("c")).select(
        text.filled(SUMMARY_SIZE, rows=F.format_number("r", 0), columns=F.col("c")).alias("message")
    )
    direction = F.when(F.col("coefficient") >= 0, SAME_DIRECTION).otherwise(OPPOSITE_DIRECTION)
    r = text.fixed(F.col("coefficient"), 2, signed=True)
    relation = _top(pairs, _strongest(pairs), text.filled(SUMMARY_RELATION, a=_lower_name("var_a"), b=_lower_name("var_b"), r=r, direction=direction))
    algorithm = F.when(F.lower("algorithm") == "kmeans", "K-Means").otherwise("DBSCAN")
    segments = clustering.filter(F.col("n_clusters") > 0).select(
        text.filled(SUMMARY_SEGMENTS, count=F.col("n_clusters"), algorithm=algorithm, quality=F.lower("calidad")).alias("message")
    )
    parts = [size, relation, segments]
    if agreement is not None:
        counts = text.filled(SUMMARY_ANOMALIES, any_signal=F.col("any_signal"), consensus=F.col("consensus"))
        parts.append(agreement.select(counts.alias("message")))
    table = reduce(DataFrame.unionByName, [p.withColumn("ord", F.lit(i)) for i, p in enumerate(parts)])
    in_order = F.array_sort(F.collect_list(F.struct("ord", "message")))
    return table.agg(in_order.alias("v")).select(F.array_join(F.col("v.message"), " ").alias("summary"))


def recommendations(pairs: DataFrame, dependencies: DataFrame, clustering: DataFrame, agreement: DataFrame | None) -> DataFrame:
    """At most five next steps ``(ord, message)``, each tied to a result."""
    relation = _top(pairs, _strongest(pairs), text.filled(ADVISE_RELATION, a=_lower_name("var_a"), b=_lower_name("var_b")))
    dependency = _top(
        dependencies, [F.col("eta_squared").desc(), F.col("ord")],
        text.filled(ADVISE_DEPENDENCY, numeric=_lower_name("numeric"), categorical=_lower_name("categorical")),
    )
    segments = clustering.filter(F.col("n_clusters") > 0).select(F.lit(ADVISE_SEGMENTS).alias("message"))
    parts = [relation, dependency, segments]
    if agreement is not None:
        first = text.filled(ADVISE_ANOMALIES, consensus=F.col("consensus"))
        parts.append(agreement.filter(F.col("consensus") > 0).select(first.alias("message")))
    parts.append(pairs.sparkSession.createDataFrame([(ADVISE_ALWAYS,)], "message string"))
    table = reduce(DataFrame.unionByName, [p.withColumn("ord", F.lit(i)) for i, p in enumerate(parts)])
    return table.orderBy("ord").limit(MAX_RECOMMENDATIONS).select("ord", "message")
