import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablescope.functions import ordered
from tablescope.functions.skew import lookup
from tablescope.functions import skew


@pytest.fixture(scope="module")
def uneven(spark):
    """4,000 rows, one value holding a third of them, some gaps."""
    rng = np.random.default_rng(3)
    a = np.where(rng.random(4000) < 0.34, 5.0, np.round(rng.normal(0, 50, 4000), 1))
    b = rng.normal(0, 1, 4000)
    pdf = pd.DataFrame({"a": a, "b": b})
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("rows_per_bucket", [10_000, 50, 1])
def test_quantiles_and_mode(uneven, rows_per_bucket):
    df, pdf = uneven
    shares = {"q0": 0.0, "q1": 0.25, "m": 0.5, "p99": 0.99, "q4": 1.0}
    table = ordered.order_statistics(df, ["a", "b"], shares, rows_per_bucket=rows_per_bucket)
    got = table.toPandas().set_index("variable")
    for c in "ab":
        for name, q in shares.items():
            assert got.loc[c, name] == pytest.approx(pdf[c].quantile(q), rel=1e-12)
        assert got.loc[c, "mode"] == pdf[c].mode().iloc[0]


@pytest.mark.parametrize("rows_per_bucket", [10_000, 1])
def test_quantiles_over_the_whole_range_of_numbers(spark, rows_per_bucket):
    rng = np.random.default_rng(8)
    wide = np.concatenate([[0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308], 10.0 ** rng.uniform(-320, 308, 500), -(10.0 ** rng.uniform(-320, 308, 500))])
    close = 1e15 + rng.integers(0, 8, 1006) * 0.125  # neighbouring numbers
    ends = np.where(np.arange(1006) % 10 == 0, np.inf, np.where(np.arange(1006) % 10 == 1, -np.inf, close))
    df = spark.createDataFrame(pd.DataFrame({"wide": wide, "close": close, "ends": ends, "one": 7.0}))
    places = np.linspace(0, 1, 1006)[[0, 1, 99, 300, 502, 503, 504, 800, 1004, 1005]]
    found = ordered.selected(df, ["wide", "close", "ends", "one"], places.tolist(), rows_per_bucket)
    for (n, values), column in zip(found, (wide, close, ends, np.full(1006, 7.0))):
        assert n == 1006 and {p: float(x) for p, x in values.items()} == {p: float(np.sort(column)[p]) for p in values} and len(values) >= 10


def test_first_digit_never_falls(spark):
    rng = np.random.default_rng(2)
    x = np.unique(np.concatenate([10.0 ** rng.uniform(-323, 308, 4000), 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1000, 1024), 0), [np.inf]]))
    x = np.concatenate([-x[::-1], [0.0], x])
    digit = spark.createDataFrame(pd.DataFrame({"x": x})).select("x", ordered._first_digit(F.col("x")).alias("d")).toPandas().sort_values("x").d.to_numpy()
    assert (np.diff(digit) >= 0).all() and np.abs(digit[1:-1]).max() < ordered.BEYOND


@pytest.mark.parametrize("partitions", [None, 37])
def test_average_ranks_with_a_hot_value(uneven, partitions):
    df, pdf = uneven
    values = ordered.long_values(df.withColumn("k", F.col("b")), ["a", "b"], ["k"])
    got = ordered.with_ranks(values, F.col("k"), ordered.cut_lineage(ordered.rank_table(values, partitions))).groupBy("k").pivot("v", [0, 1]).agg(F.first("avg_rank")).toPandas().sort_values("k")
    want = pdf.assign(ra=pdf["a"].rank(), rb=pdf["b"].rank()).sort_values("b")
    assert len(got) == len(want)
    assert np.allclose(got["0"], want["ra"]) and np.allclose(got["1"], want["rb"])
    table = ordered.rank_table(values, partitions).toPandas()
    assert (table.groupby("v").n.sum() == 4000).all() and (table.total == 4000).all() and (table.n * 64 > table.total).sum() >= 1


def test_missing_values_have_no_rank(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert ordered.quantile_parameters(df, ["x"], {"m": 0.5}) == {"x": {"m": 2.0}}
    empty = spark.createDataFrame([(None,)], "x double")
    assert ordered.quantile_parameters(empty, ["x"], {"m": 0.5}) == {"x": {"m": None}}
    assert ordered.order_statistics(empty, ["x"], {"m": 0.5}).count() == 0
    assert ordered.quantile_parameters(df, [], {"m": 0.5}) == {}


def test_dense_index(spark):
    df = spark.createDataFrame([(v,) for v in [40, 7, 7, 99, 2**60]], "k bigint")
    got = {r["k"]: r["i"] for r in ordered.dense_index(df, "k", "i").collect()}
    assert got == {7: 0, 40: 1, 99: 2, 2**60: 3}


def test_lookup_spreads_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "SMALL_ROWS", 10)
    rows = spark.range(900).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k")
    table = spark.range(1200).selectExpr("id AS k", "id * 2 AS twice")
    counts = rows.groupBy("k").count().withColumnRenamed("count", "n")
    assert len(skew.hot_key_hashes(counts, "k")) == 1
    got = lookup(rows, "k", table, "id").toPandas()
    assert len(got) == 900 and (got["twice"] == got["k"] * 2).all()
