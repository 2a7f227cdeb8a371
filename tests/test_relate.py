import numpy as np
import pandas as pd
import pytest

from tablescope.errors import UnknownMethodError
from tablescope.operators import relate


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(5)
    n = 600
    a = np.where(rng.random(n) < 0.34, 3.0, np.round(rng.normal(0, 10, n)))
    pdf = pd.DataFrame({"a": a, "b": np.round(a + rng.normal(0, 5, n), 1), "c": np.exp(a / 8), "k": 1.0})
    pdf.loc[rng.random(n) < 0.2, "b"] = np.nan
    pdf.loc[rng.random(n) < 0.2, "c"] = np.nan
    return spark.createDataFrame(pdf), pdf


def check(table, want):
    for r in table.collect():
        value = want.loc[r["var_a"], r["var_b"]]
        assert (r["coefficient"] is None) if np.isnan(value) else r["coefficient"] == pytest.approx(value, abs=1e-12)


def test_pearson_is_pairwise_complete(gappy):
    df, pdf = gappy
    check(relate.pearson(df, list(pdf.columns), diagonal=True), pdf.corr())


@pytest.mark.parametrize("partitions, broadcast", [(None, 500_000), (None, 0), (23, 0)])
def test_spearman_ranks_each_pair(gappy, monkeypatch, partitions, broadcast):
    monkeypatch.setattr(relate, "BROADCAST_RANKS", broadcast)
    df, pdf = gappy
    check(relate.spearman(df, ["a", "b", "c", "k"], diagonal=True, partitions=partitions), pdf[["a", "b", "c", "k"]].corr(method="spearman"))


def test_columns_of_one_pattern_are_ranked_once(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(400, 5)), columns=list("abcde"))
    pdf.loc[::3, ["b", "d"]] = np.nan
    pdf.loc[::7, "e"] = np.nan
    df = spark.createDataFrame(pdf)
    found = relate._patterns(df.select([relate.as_double(df, c).alias(c) for c in df.columns]))
    assert found[0] == found[2] and found[1] == found[3] and len(set(found)) == 3
    check(relate.spearman(df, list("abcde")), pdf.corr(method="spearman"))


def wide(spark, n=500, columns=40):
    """Correlated columns with gaps, a constant one, one far from zero, one constant where another is present, an infinite one."""
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(n, columns)) + rng.normal(size=(n, 1)), columns=[f"c{i}" for i in range(columns)])
    pdf["c0"] = 4.0
    pdf["c1"] = 1e9 + pdf["c1"]
    pdf.loc[rng.random(n) < 0.3, "c2"] = np.nan
    pdf.loc[pdf.index % 4 > 0, "c3"] = np.nan
    pdf["c4"] = np.where(pdf.index % 4 == 0, 5.0, pdf["c4"])
    pdf["c5"] = np.nan
    return spark.createDataFrame(pdf), pdf


def test_pearson_of_many_columns_takes_matrix_products(spark):
    df, pdf = wide(spark)
    table = relate.pearson(df, list(pdf.columns), diagonal=True)
    want = pdf.corr()
    want.loc["c3", "c4"] = want.loc["c4", "c3"] = np.nan  # constant on the complete rows
    got = table.toPandas()
    assert len(got) == 40 * 41 // 2 and got.ord.is_unique
    for r in got.itertuples():
        value = want.loc[r.var_a, r.var_b]
        assert pd.isna(r.coefficient) if np.isnan(value) else r.coefficient == pytest.approx(value, abs=1e-7 if "c1" in (r.var_a, r.var_b) else 1e-12)
        assert r.n == (pdf[r.var_a].notna() & pdf[r.var_b].notna()).sum()


def test_spearman_of_many_columns(spark, monkeypatch):
    df, pdf = wide(spark, 200, 26)
    want = pdf.corr(method="spearman")
    want.loc["c3", "c4"] = want.loc["c4", "c3"] = np.nan
    check(relate.spearman(df, list(pdf.columns)), want)
    monkeypatch.setattr(relate, "UNITS_PER_PASS", 7)
    check(relate.spearman(df, [f"c{i}" for i in range(1, 5)]), want)


@pytest.mark.parametrize("group_points", [100_000, 200, 3])
def test_kendall_against_all_pairs(gappy, group_points):
    df, pdf = gappy
    both = pdf[["a", "b"]].dropna().to_numpy()
    sx, sy = (np.sign(both[:, None, j] - both[None, :, j]) for j in (0, 1))
    want = (sx * sy).sum() / np.sqrt(float((sx != 0).sum()) * float((sy != 0).sum()))
    got = relate.kendall(df, ["a", "b"], group_points).collect()[0]
    assert got["coefficient"] == pytest.approx(want, abs=1e-12) and got["n"] == len(both)


def test_kendall_without_variation_or_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "a double, b double")
    row = relate.kendall(df, ["a", "b"]).collect()[0]
    assert row["coefficient"] is None and row["n"] == 2
    assert relate.kendall(df.where("a > 5"), ["a", "b"]).collect()[0]["n"] == 0


@pytest.mark.parametrize("group_points", [60, 1])
def test_no_group_of_kendall_is_large(spark, group_points, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.where(rng.random(1500) < 0.3, 0.0, rng.integers(0, 300, 1500))
    y = np.where(rng.random(1500) < 0.3, 9.0, rng.integers(0, 300, 1500) + x)
    df = spark.createDataFrame(pd.DataFrame({"a": x, "b": y}))
    sx, sy = (np.sign(v[:, None] - v[None, :]) for v in (x, y))
    want = (sx * sy).sum() / np.sqrt(float((sx != 0).sum()) * float((sy != 0).sum()))
    assert relate.kendall(df, ["a", "b"], group_points).collect()[0]["coefficient"] == pytest.approx(want, abs=1e-12)
    points = df.groupBy("a", "b").count().toDF("x", "y", "n").withColumn("g", relate.F.lit(0).cast("bigint"))
    parts = relate._cut_ranges(points).where("sub % 2 = 0").groupBy("sub").count().toPandas()["count"]
    assert parts.max() < points.count() / 8


def test_eta_squared_of_many_columns(spark):
    rng = np.random.default_rng(6)
    n = 300
    groups = {f"g{i}": rng.integers(0, 2 + i % 5, n).astype(str) for i in range(20)}
    numbers = {f"x{j}": rng.normal(size=n) + (groups["g3"] == "1") * j / 20 for j in range(70)}
    pdf = pd.DataFrame(groups | numbers)
    got = relate.eta_squared(spark.createDataFrame(pdf), list(groups), list(numbers)).toPandas()
    assert len(got) == 20 * 70 and got.ord.is_unique
    for r in got.sample(200, random_state=1).itertuples():
        x = pdf[r.numeric]
        between = sum(len(s) * (s.mean() - x.mean()) ** 2 for _, s in x.groupby(pdf[r.categorical]))
        assert r.eta_squared == pytest.approx(between / ((x - x.mean()) ** 2).sum(), rel=1e-9)


def test_strong_pairs_and_labels(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, -1.0 * i) for i in range(20)], "a double, b double, c double")
    rows = relate.strong_pairs(relate.correlations(df, ["a", "b", "c"], ["pearson"])).collect()
    assert [(r["var_a"], r["var_b"], r["direction"], r["strength"]) for r in rows] == [
        ("a", "b", "positiva", "fuerte"), ("a", "c", "negativa", "fuerte"), ("b", "c", "negativa", "fuerte"),
    ]
    assert relate.distinct_pairs(relate.strong_pairs(relate.correlations(df, ["a", "b", "c"]))).count() == 3


def test_one_column_has_no_pairs_and_unknown_method_raises(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    assert relate.correlations(df, ["a"]).count() == 0
    with pytest.raises(UnknownMethodError):
        relate.correlations(df, ["a"], ["cosine"])


def test_eta_squared(spark):
    rows = [("a", 1.0, 5.0)] * 10 + [("b", 100.0, 5.0)] * 10 + [(None, 3.0, 5.0), ("a", None, 5.0)]
    df = spark.createDataFrame(rows, "g string, v double, k double")
    got = {r["numeric"]: r["eta_squared"] for r in relate.eta_squared(df, ["g"], ["v", "k"]).collect()}
    assert got["v"] == pytest.approx(1.0) and got["k"] is None
    assert [r["numeric"] for r in relate.dependencies(df, ["g"], ["v", "k"]).collect()] == ["v"]
    single = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0)], "g string, v double")
    assert relate.eta_squared(single, ["g"], ["v"]).collect()[0]["eta_squared"] is None
