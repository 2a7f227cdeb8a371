import pytest

from tablescope.operators import clean, profile


def test_trim_and_blank(spark):
    df = spark.createDataFrame([("  hola ", 1), ("", 2), (" chao\t", 3)], "texto string, id bigint")
    assert [r["texto"] for r in clean.trim_text(df).orderBy("id").collect()] == ["hola", None, "chao"]


def test_empty_rows_and_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "a double, vacia double")
    cleaned = clean.basic_clean(df)
    assert cleaned.columns == ["a", "_row_id"] and sorted(r["a"] for r in cleaned.collect()) == [1.0, 3.0]
    s = clean.cleaning_summary(df, cleaned).collect()[0]
    assert (s["removed_rows"], s["removed_columns"]) == (2, 1)


def test_duplicates_keep_the_first_row(spark):
    df = spark.createDataFrame([(5, 1, "x"), (3, 1, "x "), (9, 2, "y")], "id bigint, a bigint, b string")
    assert sorted(map(tuple, clean.basic_clean(df, "id").collect())) == [(3, 1, "x"), (9, 2, "y")]


def test_logical_types(mixed):
    table = profile.column_profile(mixed)
    got = {r["name"]: r for r in table.collect()}
    assert [got[c]["logical_type"] for c in mixed.columns] == ["numeric", "numeric", "categorical", "boolean", "datetime"]
    assert got["ingreso"]["missing_count"] == 1 and got["ingreso"]["missing_ratio"] == pytest.approx(1 / 6)
    assert got["region"]["sample_values"] == ["Norte", "Sur", "Centro"] and got["region"]["unique_count"] == 3
    p = profile.load_profile(table)
    assert (p.n_rows, p.n_cols, p.names("numeric"), p.names("categorical", "boolean")) == (6, 5, ["edad", "ingreso"], ["region", "activo"])


def test_type_rules(spark):
    rows = [(True, "id-1", None, "1", [1], "2020-01-01 10:00"), (False, "id-2", None, "0", [2], "nope"), (None, "id-3", None, "1", [3], "2020-05-01")]
    df = spark.createDataFrame(rows, "b boolean, t string, u string, n string, nested array<int>, d string")
    got = {r["name"]: r["logical_type"] for r in profile.column_profile(df).collect()}
    assert got == {"b": "boolean", "t": "text", "u": "unknown", "n": "boolean", "nested": "unknown", "d": "text"}


def test_sample_values_follow_row_order_and_limit(spark):
    df = spark.range(100).selectExpr("id", "CAST(99 - id AS STRING) AS v")
    got = profile.column_profile(df, ["v"], "id", max_samples=3).collect()[0]
    assert got["sample_values"] == ["99", "98", "97"]


def test_one_shuffle_feeds_distinct_counts_and_samples(spark, mixed):
    plan = profile.column_profile(mixed)._jdf.queryExecution()
    profile.column_profile(mixed).collect()
    assert "WindowGroupLimit" in plan.executedPlan().toString()
