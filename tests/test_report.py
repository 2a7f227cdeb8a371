import re

import pytest
from pyspark.sql import functions as F

from tablescope import errors, session
from tablescope.config import AnalysisConfig
from tablescope.functions import text
from tablescope.errors import UnknownMethodError
from tablescope.operators import segments
from tablescope.plans.report import Analyzer, basic_statistics


@pytest.fixture(scope="module")
def report(spark, groups):
    return Analyzer(spark, AnalysisConfig(kmeans_k=3), basic_statistics).analyze(groups, "id")


def test_whole_analysis(report):
    assert (report.profile.n_rows, report.profile.n_cols) == (90, 3)
    assert report.anomaly_methods == ["zscore", "iqr", "isolation_forest"] and report.anomaly_summary.count() == 3
    assert report.clustering.n_clusters == 3
    assert {r["variable"] for r in report.descriptive.collect()} == {"x", "y"}
    messages = [r["message"] for r in report.insights.collect()]
    assert messages[0].startswith("El conjunto de datos contiene 90 registros y 3 variables (2 numéricas, 1 categóricas")
    assert any("explica un" in m for m in messages) and any("KMEANS" in m for m in messages)
    assert [r["category"] for r in report.insights.collect()][-3:] == ["anomaly"] * 3
    assert "3 segmentos mediante K-Means" in report.executive_summary().collect()[0]["summary"]
    assert 3 <= report.recommendations().count() <= 5


def test_segments_of_the_report(report):
    rows = report.segment_profiles().collect()
    assert [r["nombre"] for r in rows] == ["Segmento 1", "Segmento 2", "Segmento 3"]
    assert all(r["tamano"] == 30 and r["categorias"][0]["porcentaje"] == 100 for r in rows)
    assert report.segment_table().collect()[-1]["Segmento"] == "General"


def test_noise_comes_last_and_all_noise_gives_nothing(spark):
    df = spark.createDataFrame([(1, 1.0, "a", -1), (2, 5.0, "a", 0), (3, 6.0, "b", 0), (4, None, None, 1)], "id bigint, v double, c string, label int")
    rows = segments.segment_profiles(df, ["v"], ["c"]).collect()
    assert [r["nombre"] for r in rows] == ["Segmento 1", "Segmento 2", "Sin grupo"]
    assert rows[1]["rasgos"] == [] and rows[1]["categorias"] == []
    assert segments.segment_profiles(df.withColumn("label", df["label"] * 0 - 1), ["v"], ["c"]).count() == 0


def test_cleaning_can_be_switched_off(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, 2.0), (3, 3.0)], "a bigint, b double")
    light = dict(anomaly_methods=["iqr"], min_rows_for_ml=100)
    assert Analyzer(spark, AnalysisConfig(**light)).analyze(df).profile.n_rows == 3
    assert Analyzer(spark, AnalysisConfig(enable_basic_cleaning=False, **light)).analyze(df).profile.n_rows == 4


def test_many_files_and_failing_provider(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("a,b\n" + "\n".join(f"{i},{i % 2}" for i in range(8)))
    config = AnalysisConfig(anomaly_methods=["zscore"], min_rows_for_ml=100, correlation_methods=["pearson"])

    def failing(df, profile):
        raise RuntimeError("broken")

    reports = Analyzer(spark, config, failing).analyze_many([str(good), str(tmp_path / "absent.csv")])
    assert list(reports) == [str(good)] and reports[str(good)].descriptive is None
    assert reports[str(good)].metadata.collect()[0]["n_rows"] == 8


def test_text_only_data(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    found = Analyzer(spark).analyze(df)
    assert found.clustering is None and found.anomalies is None and found.correlations.count() == 0
    assert found.review_queue().columns == ["_row_id", "metodos", "coincidencias", "prioridad"] and found.review_queue().count() == 0
    assert found.insights.count() == 1


def test_unknown_algorithm_leaves_clustering_out(spark, outlier):
    config = AnalysisConfig(clustering_algorithm="optics", anomaly_methods=[], correlation_methods=["pearson"])
    found = Analyzer(spark, config).analyze(outlier, "id")
    assert found.clustering is None and found.segment_profiles() is None and found.anomaly_methods == []
    assert [r["category"] for r in found.insights.collect()] == ["dataset"]


def test_wrong_configuration_is_loud_for_many_files(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("a,b\n" + "\n".join(f"{i},{i % 2}" for i in range(8)))
    with pytest.raises(UnknownMethodError):
        Analyzer(spark, AnalysisConfig(correlation_methods=["foo"])).analyze_many([str(good)])


def test_dotted_names_and_negative_zero(spark):
    rows = [(i, float(i % 7) if i % 11 else None, -0.0 if i % 2 else 0.0, float(i), "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, `a.b` double, `c.d` double, `e.f` double, `g.h` string")
    for algorithm in ("kmeans", "dbscan"):
        config = AnalysisConfig(clustering_algorithm=algorithm, kmeans_k=2, correlation_methods=["pearson", "spearman", "kendall"])
        found = Analyzer(spark, config, basic_statistics).analyze(df, "id")
        assert found.clustering is not None and found.correlations.count() == 9 and len(found.anomaly_methods) == 3
        assert found.insights.count() > 1 and found.segment_table().count() >= 1 and found.review_queue().columns[0] == "id"
    counts = {r["name"]: r["unique_count"] for r in found.profile.table.collect()} if "name" in found.profile.table.columns else None
    assert counts is None or counts["c.d"] == 1


def folders(spark):
    root = spark._jvm.org.apache.hadoop.fs.Path(session.shared_folder(spark))
    at = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return {x.getPath().getName() for x in at.listStatus(root)} if at.exists(root) else set()


def test_a_closed_report_leaves_no_files(spark, mixed):
    before = folders(spark)
    config = AnalysisConfig(anomaly_methods=["zscore", "iqr"], kmeans_k=2)
    with Analyzer(spark, config, basic_statistics).analyze(mixed) as report:
        assert folders(spark) > before
        assert report.insights.count() > 0 and report.segment_profiles().count() == 2 and report.review_queue().count() >= 0
        report.executive_summary().collect()
    assert folders(spark) == before
    with pytest.raises(errors.EmptyDatasetError):
        Analyzer(spark, config).analyze(mixed.where("edad < 0"))
    assert folders(spark) == before


def test_tables_go_with_the_innermost_holder(spark):
    outer, inner = session.Intermediates(), session.Intermediates()
    before = folders(spark)
    with outer:
        session.cut_lineage(spark.range(3))
        with inner:
            kept = session.cut_lineage(spark.range(4))
    assert len(outer.paths) == len(inner.paths) == 1 and kept.count() == 4 and len(folders(spark) - before) == 2
    inner.close()
    assert len(folders(spark) - before) == 1
    outer.close()
    outer.close()
    assert folders(spark) == before


def test_times_are_shown_by_their_own_clock(spark, report):
    given = ["2024-03-05T17:08:59", "2024-03-05 17:08:59.5+09:00", "2024-03-05", "2024-03-05T17:08", "ayer", "2024-13-40", "2024", "", None]
    shown = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, g string").select("i", text.shown_time(F.col("g")).alias("s")).orderBy("i")
    assert [r["s"] for r in shown.collect()] == [*["05/03/2024 17:08"] * 2, "05/03/2024 00:00", "05/03/2024 17:08", "ayer", "2024-13-40", "2024", *["Fecha no disponible"] * 2]
    row = report.header().collect()[0]
    assert row["n_rows"] == 90 and re.fullmatch(r"\d\d/\d\d/\d{4} \d\d:\d\d", row["generado"])
