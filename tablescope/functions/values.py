"""Column expressions that give every operator one notion of "missing"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?(inf|infinity)\s*$"


def quoted(name: str) -> str:
    """Column name safe for ``F.col`` whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_datetime(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))


def text_to_double(text: Column) -> Column:
    """Number held as text, NULL when the text is not a number."""
    infinite = F.when(text.rlike(INFINITY_PATTERN), F.when(F.trim(text).startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double")).otherwise(infinite)


def as_double(df: DataFrame, name: str, finite: bool = False) -> Column:
    """Column as double with NaN (and, if asked, infinities) turned into NULL.

    Adding zero turns -0.0 into 0.0, so that equal values are also equal to
    hash sets and binary searches, which tell the two apart.
    """
    dtype = df.schema[name].dataType
    source = col(name)
    value = text_to_double(source) if isinstance(dtype, T.StringType) else source.cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.StringType)):
        present = F.abs(value) < F.lit(float("inf")) if finite else ~F.isnan(value)
        value = F.when(present, value + F.lit(0.0))
    return value


def numeric_frame(df: DataFrame, cols: list[str], keep: list[str] | None = None, finite: bool = False) -> DataFrame:
    """Projection of ``cols`` as double, next to the untouched ``keep`` columns."""
    kept = [col(c) for c in keep or []]
    return df.select(*kept, *[as_double(df, c, finite).alias(c) for c in cols])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floats}) if floats else df


def strip(text: Column) -> Column:
    """Trim every kind of white space, also non-breaking spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def value_text(df: DataFrame, name: str) -> Column:
    """Value as text, for tables that hold several columns one below another."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(col(name) == 0, F.lit(0).cast(dtype)).otherwise(col(name)).cast("string")  # -0.0 is 0.0
    return F.to_json(col(name)) if is_nested(dtype) and not isinstance(dtype, T.BinaryType) else col(name).cast("string")


def first_row_id(df: DataFrame, key: str | None) -> tuple[DataFrame, str]:
    """The caller's key, or an id taken once from the order of the scan."""
    if key:
        return df, key
    return df.withColumn("_row_id", F.monotonically_increasing_id()), "_row_id"
