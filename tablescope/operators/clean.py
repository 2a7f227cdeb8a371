"""Basic cleaning: trim, blank to missing, empty columns and rows, exact duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.values import col, first_row_id, nan_to_null, numeric_frame, quoted, strip


def data_columns(df: DataFrame, key: str | None) -> list[str]:
    return [c for c in df.columns if c != key]


def trim_text(df: DataFrame, key: str | None = None) -> DataFrame:
    """Strip text cells; cells left empty become missing."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != key]
    return df.withColumns({c: F.nullif(strip(col(c)), F.lit("")) for c in texts}) if texts else df


def drop_empty_columns(df: DataFrame, key: str | None = None) -> DataFrame:
    """Drop columns without any value; runs one counting job."""
    cols = data_columns(df, key)
    if not cols:
        return df
    counts = df.agg(*[F.count(col(c)).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    empty = {c for i, c in enumerate(cols) if counts[i] == 0}
    return df.select(*[col(c) for c in df.columns if c not in empty])


def drop_empty_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Drop rows whose data columns are all missing."""
    return df.na.drop(how="all", subset=[quoted(c) for c in data_columns(df, key)])


def drop_duplicate_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Keep one of equal rows; with a key, the one with the smallest key."""
    cols = data_columns(df, key)
    if key is None:
        return df.dropDuplicates()
    return df.groupBy(*[col(c) for c in cols]).agg(F.min(col(key)).alias(key)).select(*[col(c) for c in df.columns])


def basic_clean(df: DataFrame, key: str | None = None) -> DataFrame:
    """All cleaning steps in order.

    ``key`` is a row id that takes no part in the cleaning.  Without one an id
    from the scan order is added as ``_row_id``, so that the first of equal
    rows stays and later results can refer to rows.
    """
    df, key = first_row_id(df, key)
    steps = nan_to_null(df).transform(trim_text, key).transform(drop_empty_columns, key)
    return steps.transform(drop_empty_rows, key).transform(drop_duplicate_rows, key)


def cleaning_summary(before: DataFrame, after: DataFrame, key: str | None = None) -> DataFrame:
    """One row: how many rows and columns the cleaning removed."""
    rows = before.agg(F.count(F.lit(1)).alias("rows_before")).select(
        F.struct("rows_before").alias("b"), F.lit(None).cast("struct<rows_after:bigint>").alias("a")
    )
    kept = after.agg(F.count(F.lit(1)).alias("rows_after")).select(
        F.lit(None).cast("struct<rows_before:bigint>").alias("b"), F.struct("rows_after").alias("a")
    )
    removed = len(data_columns(before, key)) - len(data_columns(after, key if key in after.columns else "_row_id"))
    both = rows.unionByName(kept).agg(F.max("b.rows_before").alias("rows_before"), F.max("a.rows_after").alias("rows_after"))
    return both.select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("removed_rows"), F.lit(removed).cast("bigint").alias("removed_columns")
    )


def complete_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """The two columns, rows with a gap in either dropped."""
    return df.select(col(a), col(b)).dropna(subset=[quoted(a), quoted(b)])


def coerce_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns as double; what is not a number becomes missing."""
    others = [c for c in df.columns if c not in cols]
    return numeric_frame(df, cols, keep=others).select(*[col(c) for c in df.columns])
