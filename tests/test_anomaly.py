import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescope.config import AnalysisConfig
from tablescope.operators import anomaly, features, iforest


def test_every_method_finds_the_outlier(outlier):
    numbers = features.impute_median(outlier, ["valor", "otro"], ["id"])
    flagged, methods = anomaly.detect_anomalies(numbers, ["valor", "otro"], "id")
    assert methods == ["zscore", "iqr", "isolation_forest"]
    last = flagged.filter("id = 30").collect()[0]
    assert last["is_zscore"] and last["is_iqr"] and last["is_isolation_forest"]
    summary = {r["method"]: r["outlier_count"] for r in anomaly.anomaly_summary(flagged, methods).collect()}
    assert summary["zscore"] == 1 and summary["iqr"] == 1 and 1 <= summary["isolation_forest"] <= 10
    first = anomaly.review_queue(flagged, methods, "id").collect()[0]
    assert (first["id"], first["coincidencias"], first["prioridad"], first["metodos"]) == (30, 3, "Alta", "Z-Score, IQR, Isolation Forest")


def test_unknown_methods_are_skipped(outlier):
    numbers = features.impute_median(outlier, ["valor"], ["id"])
    flagged, methods = anomaly.detect_anomalies(numbers, ["valor"], "id", AnalysisConfig(anomaly_methods=["IQR", "other"]))
    assert methods == ["iqr"] and "is_zscore" not in flagged.columns


def test_constant_columns_have_no_z_scores(spark):
    df = spark.createDataFrame([(i, 0.1, float(i)) for i in range(5)], "id bigint, k double, v double")
    assert [r["variable"] for r in anomaly.zscore_counts(df, ["k", "v"]).collect()] == ["v"]


def test_forest_is_repeatable_and_orders_outliers_first(spark):
    rng = np.random.default_rng(1)
    points = [(i, *map(float, p)) for i, p in enumerate(rng.normal(0, 1, (400, 2)))] + [(400, 15.0, 15.0), (401, -14.0, 12.0)]
    df = spark.createDataFrame(points, "id bigint, a double, b double")
    scores = iforest.isolation_scores(df, ["a", "b"], "id").toPandas().set_index("id")["iforest_score"]
    again = iforest.isolation_scores(df.repartition(3), ["a", "b"], "id").toPandas().set_index("id")["iforest_score"]
    assert np.allclose(scores.sort_index(), again.sort_index()) and scores.between(0, 1).all()
    assert set(scores.nlargest(2).index) == {400, 401}
    share = iforest.isolation_forest_flags(df, ["a", "b"], "id", 0.05).filter("is_isolation_forest").count()
    assert 15 <= share <= 21


def test_tree_samples_are_bounded(spark):
    df = spark.range(20_000).select(F.col("id"), F.rand(3).alias("a"))
    sizes = [r["count"] for r in iforest.tree_samples(df, ["a"], "id", 20_000, 42, trees=10).groupBy("tree").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= iforest.SAMPLE_ROWS and min(sizes) > 200


def test_average_path():
    assert (iforest.average_path(1), iforest.average_path(2)) == (0.0, 1.0)
    assert iforest.average_path(256) == pytest.approx(10.244, abs=1e-3)
