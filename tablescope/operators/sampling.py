"""Hash samples, repeatable and independent of partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.values import col

HASH_RANGE = 2**31


def hash_sample(df: DataFrame, key: str, rows: int | None, seed: int) -> DataFrame:
    """About ``rows`` rows by key hash, or all of them where the caller asks for no sample."""
    if rows is None:
        return df
    n_rows = df.agg(F.count(F.lit(1))).first()[0]
    share = int(HASH_RANGE * min(1.0, rows / max(1, n_rows)))
    return df.filter(F.pmod(F.xxhash64(col(key), F.lit(seed)), F.lit(HASH_RANGE)) < share)
