"""Logical type, gaps, distinct values and examples of every column."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import text
from ..functions.values import col, first_row_id, is_datetime, is_nested, is_number, nan_to_null, strip, value_text

# ---------------------------------------------------------------- fixed values
BOOLEAN_TOKENS = ("true", "false", "yes", "no", "si", "sí", "1", "0", "t", "f")
CATEGORICAL_RATIO = 0.5
DATE_SAMPLE_ROWS = 50
DATE_SHARE = 0.9
DATE_SEPARATOR = "[-/:]"
# -----------------------------------------------------------------------------
SHORT_TEXT = 64  # characters up to which a value is its own key
DATE_FORMATS = (
    "yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "yyyy-M", "d/M/yyyy", "M/d/yyyy", "d-M-yyyy", "M-d-yyyy",
    "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMM d yyyy", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m",
    "yyyy-M-d'T'H:m:s.SSSSSS", "yyyy-M-d'T'H:m:s.SSS", "yyyy-M-d'T'H:m:sXXX", "yyyy-M-d'T'H:m:s.SSSXXX",
    "yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d H:m:s.SSS", "yyyy-M-d H:m:sXXX",
    "yyyy/M/d H:m:s", "yyyy/M/d H:m", "d/M/yyyy H:m:s", "d/M/yyyy H:m", "M/d/yyyy H:m:s", "M/d/yyyy H:m",
    "d-M-yyyy H:m:s", "d-M-yyyy H:m", "H:m:s", "H:m",
)


def date_from_text(value: Column) -> Column:
    """First supported date format that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in DATE_FORMATS])


def boolean_token(value: Column) -> Column:
    return F.lower(strip(value)).isin(*BOOLEAN_TOKENS)


def long_values(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """``(_id, ord, value)``: every value present, as text, one per row."""
    texts = df.select(col(key).alias("_id"), *[value_text(df, c).alias(f"_c{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(i).alias("ord"), F.col(f"_c{i}").alias("value")) for i in range(len(cols))]
    return texts.select("_id", F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def digest(value: Column) -> Column:
    """A mark and a SHA-256; longer than any short text, so never equal to one."""
    return F.concat(F.lit("\0"), F.sha2(value.cast("binary"), 256))


def value_histogram(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """``(ord, value, n, first_id)`` over all columns: one shuffle of combined counts.

    A value longer than ``SHORT_TEXT`` goes by its digest, so free text is never shuffled.
    """
    long = long_values(df, cols, key).withColumn("value", F.when((F.length("value") <= SHORT_TEXT) | boolean_token(F.col("value")), F.col("value")).otherwise(digest(F.col("value"))))
    return long.groupBy("ord", "value").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first_id"))


def gap_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(ord, name, n_rows, missing_count, missing_ratio)`` in one pass."""
    clean = nan_to_null(df.select(*[col(c) for c in cols]))
    wide = clean.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(col(c)).alias(f"_{i}") for i, c in enumerate(cols)])
    cells = [
        F.struct(F.lit(i).alias("ord"), F.lit(c).alias("name"), (F.col("n_rows") - F.col(f"_{i}")).alias("missing_count"))
        for i, c in enumerate(cols)
    ]
    return wide.select("n_rows", F.inline(F.array(*cells))).withColumn(
        "missing_ratio", F.coalesce(F.col("missing_count") / F.nullif(F.col("n_rows"), F.lit(0)), F.lit(0.0))
    )


def sample_values(histogram: DataFrame, limit: int, df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """First distinct values of each column in row order.

    The rank filter is pushed below the shuffle, so a task passes on at most
    ``limit`` rows per column; long values are then fetched by row id.
    """
    in_order = Window.partitionBy("ord").orderBy("first_id", "value")
    firsts = histogram.filter(F.col("n") > 0).withColumn("place", F.row_number().over(in_order)).filter(F.col("place") <= limit)
    texts = [c for c in cols if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType)) or is_nested(df.schema[c].dataType)]
    if texts:
        # at most ``limit`` rows per column
        wanted = F.broadcast(firsts.filter(F.col("value").startswith("\0")).select(F.col("ord").alias("of"), F.col("first_id").alias("at")))
        numbers = F.element_at(F.array(*[F.lit(cols.index(c)) for c in texts]), F.col("ord") + 1)
        whole = long_values(df, texts, key).withColumn("ord", numbers).join(wanted, (F.col("ord") == F.col("of")) & (F.col("_id") == F.col("at"))).select("ord", F.col("_id").alias("first_id"), F.col("value").alias("whole"))
        firsts = firsts.join(F.broadcast(whole), ["ord", "first_id"], "left").withColumn("value", F.coalesce("whole", "value"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    return firsts.groupBy("ord").agg(ordered.alias("v")).select("ord", F.col("v.value").alias("sample_values"))


def date_share(df: DataFrame, cols: list[tuple[int, str]], key: str) -> DataFrame:
    """``(ord, has_separator, date_share)`` over the first rows of text columns."""
    cells = [F.struct(F.lit(i).alias("ord"), col(c).alias("value")) for i, c in cols]
    long = df.select(col(key).alias("_id"), F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    # the rank filter is pushed below the shuffle: one scan, a few rows per task and column
    place = F.row_number().over(Window.partitionBy("ord").orderBy("_id"))
    sample = long.withColumn("place", place).filter(F.col("place") <= DATE_SAMPLE_ROWS)
    return sample.groupBy("ord").agg(
        F.bool_or(F.col("value").rlike(DATE_SEPARATOR)).alias("has_separator"),
        F.avg(date_from_text(F.col("value")).isNotNull().cast("int")).alias("date_share"),
    )


def column_profile(df: DataFrame, cols: list[str] | None = None, key: str | None = None, max_samples: int = 5) -> DataFrame:
    """One row per column: ``ord, name, physical_type, logical_type, n_rows,
    missing_count, missing_ratio, unique_count, sample_values``."""
    df, row_key = first_row_id(df, key)
    cols = [c for c in (cols or df.columns) if c != "_row_id"]
    df = nan_to_null(df)
    types = {c: df.schema[c].dataType for c in cols}
    flat = [c for c in cols if not is_nested(types[c])]
    gaps = gap_counts(df, cols)
    histogram = value_histogram(df, cols, row_key)
    normal = F.lower(strip(F.col("value")))
    seen = reduce(Column.__add__, [F.max((normal == t).cast("int")) for t in BOOLEAN_TOKENS])
    # uses the same columns of the histogram as the samples do, so both read one shuffle
    values = histogram.groupBy("ord").agg(
        F.count(F.lit(1)).alias("unique_count"), F.bool_and(normal.isin(*BOOLEAN_TOKENS)).alias("only_tokens"), seen.alias("tokens"),
        F.sum("n").alias("present"), F.min("first_id").alias("first_id"),
    )
    texts = [(i, c) for i, c in enumerate(cols) if isinstance(types[c], T.StringType)]
    # every joined table holds one row per column of the data set
    table = gaps.join(F.broadcast(values), "ord", "left").join(F.broadcast(sample_values(histogram, max_samples, df, cols, row_key)), "ord", "left")
    if texts:
        table = table.join(F.broadcast(date_share(df, texts, row_key)), "ord", "left")
    else:
        table = table.withColumns({"has_separator": F.lit(False), "date_share": F.lit(0.0)})
    family = {
        c: "boolean" if isinstance(t, T.BooleanType) else "datetime" if is_datetime(t) else "numeric" if is_number(t) else "string" if c in flat else "nested"
        for c, t in types.items()
    }
    present = F.when(F.col("first_id").isNotNull(), F.col("present")).otherwise(0)
    kind = F.element_at(F.array(*[F.lit(family[c]) for c in cols]), F.col("ord") + 1)
    logical = (
        F.when((present == 0) | (kind == "nested"), "unknown")
        .when(kind != "string", kind)
        .when(F.col("only_tokens") & (F.col("tokens") <= 2), "boolean")
        .when(F.col("has_separator") & (F.col("date_share") >= DATE_SHARE), "datetime")
        .when(F.col("unique_count") / F.nullif(present, F.lit(0)) <= CATEGORICAL_RATIO, "categorical")
        .otherwise("text")
    )
    physical = F.element_at(F.array(*[F.lit(types[c].simpleString()) for c in cols]), F.col("ord") + 1)
    return table.select(
        "ord", "name", physical.alias("physical_type"), logical.alias("logical_type"), "n_rows", "missing_count", "missing_ratio",
        F.coalesce("unique_count", F.lit(0)).cast("bigint").alias("unique_count"),
        F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
    )


def dataset_profile(profile: DataFrame) -> DataFrame:
    """One row: size and the count of columns of each type."""
    def of_type(kind: str) -> Column:
        return F.count(F.when(F.col("logical_type") == kind, 1))

    return profile.agg(
        F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_cols"),
        *[of_type(k).alias(f"n_{k}") for k in text.TYPE_LABELS],
        F.sum("missing_count").alias("missing_total"),
    )


def columns_by_type(profile: DataFrame) -> DataFrame:
    """``(logical_type, names)`` with the names in column order."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "name")))
    known = profile.filter(F.col("logical_type") != "unknown")
    return known.groupBy("logical_type").agg(ordered.alias("v")).select("logical_type", F.col("v.name").alias("names"))


def type_composition(profile: DataFrame) -> DataFrame:
    """``(tipo, variables)`` for the types that occur."""
    counts = profile.filter(F.col("logical_type") != "unknown").groupBy("logical_type").agg(F.count(F.lit(1)).alias("variables"))
    return counts.select(text.mapped(F.col("logical_type"), text.COMPOSITION_LABELS, F.col("logical_type")).alias("tipo"), "variables")


def missing_total(profile: DataFrame) -> DataFrame:
    return profile.agg(F.sum("missing_count").alias("missing_total"))


def profile_view(profile: DataFrame) -> DataFrame:
    """Profile with display headings, percentages and joined examples."""
    joined = F.array_join("sample_values", ", ")
    return profile.orderBy("ord").select(
        F.col("name").alias("Variable"),
        text.mapped(F.col("logical_type"), text.TYPE_LABELS, F.col("logical_type")).alias("Tipo detectado"),
        F.col("missing_count").alias("Faltantes"),
        F.concat(text.fixed(F.col("missing_ratio") * 100, 1), F.lit("%")).alias("% faltante"),
        F.col("unique_count").alias("Valores únicos"),
        F.when(joined == "", "—").otherwise(joined).alias("Ejemplos"),
    )


@dataclass
class Profile:
    """The profile on the driver: one small record per column."""

    n_rows: int
    n_cols: int
    columns: list[dict] = field(default_factory=list)
    table: DataFrame | None = None

    def names(self, *kinds: str) -> list[str]:
        return [c["name"] for k in kinds for c in self.columns if c["logical_type"] == k]


def load_profile(table: DataFrame) -> Profile:
    """Bring the profile to the driver, where it decides which analyses run."""
    rows = [r.asDict() for r in table.orderBy("ord").collect()]
    n_rows = rows[0]["n_rows"] if rows else 0
    spark = table.sparkSession
    local = spark.createDataFrame([tuple(r.values()) for r in rows], table.schema) if rows else table
    return Profile(n_rows, len(rows), rows, local)
