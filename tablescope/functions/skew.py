"""Equi-joins whose keys may be very unevenly filled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_SHARE = 64  # a key holding more than 1/64 of the rows is hot: at most 64 such keys
SALTS = 64
SMALL_ROWS = 1_000_000  # below this a hot key is still a small task


def hot_key_hashes(counts: DataFrame, key: str, n: str = "n", total: int | None = None) -> list[int]:
    """Hashes of the keys holding more than 1/64 of all rows, from a count per key."""
    if total is None:
        total = counts.agg(F.sum(n)).first()[0] or 0
    if total <= SMALL_ROWS:
        return []
    hot = counts.filter(F.col(n) > total // HOT_SHARE).select(F.xxhash64(F.col(key)).alias("h"))
    return [r["h"] for r in hot.collect()]


def is_hot(key: Column, hashes: list[int]) -> Column:
    return F.xxhash64(key).isin(hashes) if hashes else F.lit(False)


def salted_join(big: DataFrame, small: DataFrame, key: str, hashes: list[int], spread: Column, how: str = "inner") -> DataFrame:
    """Join on ``key``; rows of ``big`` with a hot key are spread by ``spread``.

    Rows of ``small`` with a hot key are repeated once per salt, so each row
    of ``big`` still meets each of its partners exactly once.
    """
    if not hashes:
        return big.join(small, key, how)
    hot = is_hot(F.col(key), hashes)
    spread_out = big.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = small.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))
    return spread_out.join(repeated, [key, "_salt"], how).drop("_salt")


def lookup(rows: DataFrame, key: str, table: DataFrame, spread: str, how: str = "left") -> DataFrame:
    """Join rows with a one-row-per-key table, hot keys found by counting first."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    hashes = hot_key_hashes(counts, key, "n", total) if total > SMALL_ROWS else []
    return salted_join(rows, table, key, hashes, F.col(spread), how)
