"""The whole analysis of one data set, or of several."""

from __future__ import annotations

import functools
import logging
import time
from dataclasses import dataclass, field
from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import AnalysisConfig
from ..errors import TablescopeError, UnknownMethodError
from ..functions import text
from ..functions.values import first_row_id, nan_to_null
from ..operators import anomaly, clean, cluster, describe, features, insights, profile as profiling, relate, segments
from ..session import Intermediates, cut_lineage
from ..sources.files import load_dataset, require_content

logger = logging.getLogger(__name__)

Provider = Callable[[DataFrame, profiling.Profile], DataFrame | None]


def basic_statistics(df: DataFrame, profile: profiling.Profile) -> DataFrame:
    """Default statistics provider: the descriptive table of the numeric columns."""
    return describe.describe(df, profile.names("numeric"))


def _kept(method: Callable) -> Callable:
    """A method of a report whose intermediate tables go with the report."""

    @functools.wraps(method)
    def inside(self: Report, *args, **kwargs):
        with self.written:
            return method(self, *args, **kwargs)

    return inside


@dataclass
class Report:
    """Results as DataFrames, evaluated when used; ``data`` is the cleaned table.

    They read tables in the shared folder, which :meth:`close` (or leaving the
    report as a context) deletes.
    """

    data: DataFrame
    key: str
    profile: profiling.Profile
    correlations: DataFrame | None = None
    strong_pairs: DataFrame | None = None
    dependencies: DataFrame | None = None
    clustering: cluster.Clustering | None = None
    anomalies: DataFrame | None = None
    anomaly_methods: list[str] = field(default_factory=list)
    anomaly_summary: DataFrame | None = None
    descriptive: DataFrame | None = None
    insights: DataFrame | None = None
    metadata: DataFrame | None = None
    written: Intermediates = field(default_factory=Intermediates)

    def __enter__(self) -> Report:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.written.close()

    @property
    def categorical_columns(self) -> list[str]:
        return self.profile.names("categorical", "boolean")

    def header(self) -> DataFrame:
        """The size of the run and when it was, for display."""
        return self.metadata.select("source", "n_rows", "n_cols", text.shown_time(F.col("generated_at")).alias("generado"))

    @_kept
    def categorical_summary(self) -> DataFrame:
        return describe.categorical_summary(self.data, self.categorical_columns)

    @_kept
    def labelled_rows(self) -> DataFrame:
        return self.data.join(self.clustering.rows.select(self.key, "label"), self.key)

    @_kept
    def segment_profiles(self) -> DataFrame | None:
        if self.clustering is None or self.clustering.n_clusters == 0:
            return None
        return segments.segment_profiles(self.labelled_rows(), self.clustering.features, self.categorical_columns)

    @_kept
    def segment_table(self) -> DataFrame | None:
        if self.clustering is None or self.clustering.n_clusters == 0:
            return None
        return segments.segment_table(self.labelled_rows(), self.clustering.features, self.categorical_columns)

    @_kept
    def distinct_pairs(self) -> DataFrame:
        """Strong pairs the summary speaks of: linear or monotone, each once."""
        return relate.distinct_pairs(self.strong_pairs.filter(self.strong_pairs["method"].isin("pearson", "spearman")))

    @_kept
    def clustering_summary(self) -> DataFrame:
        return insights.clustering_summary(self.data.sparkSession, self.clustering)

    @_kept
    def agreement(self) -> DataFrame | None:
        return anomaly.agreement_counts(self.anomalies, self.anomaly_methods) if self.anomaly_methods else None

    @_kept
    def review_queue(self) -> DataFrame:
        return anomaly.review_queue(self.data if self.anomalies is None else self.anomalies, self.anomaly_methods, self.key)

    @_kept
    def executive_summary(self) -> DataFrame:
        return insights.executive_summary(self.profile.table, self.distinct_pairs(), self.clustering_summary(), self.agreement())

    @_kept
    def recommendations(self) -> DataFrame:
        return insights.recommendations(self.distinct_pairs(), self.dependencies, self.clustering_summary(), self.agreement())


class Analyzer:
    """Runs every analysis that suits a data set; a failing stage is left out."""

    def __init__(self, spark: SparkSession, config: AnalysisConfig | None = None, provider: Provider | None = None) -> None:
        self.spark = spark
        self.config = config or AnalysisConfig()
        self.provider = provider

    def analyze(self, source: str | DataFrame, key: str | None = None, **options) -> Report:
        """Analyse a file path or a DataFrame.

        ``key`` names a row id that is kept out of the analysis; without one
        rows are numbered in scan order.  The cleaned table is written to the
        shared folder, so ids stay the same in every later job.
        """
        written = Intermediates()
        try:
            with written:
                report = self._analysed(source, key, options)
        except BaseException:
            written.close()
            raise
        report.written = written
        return report

    def _analysed(self, source: str | DataFrame, key: str | None, options: dict) -> Report:
        start = time.perf_counter()
        config = self.config
        is_frame = isinstance(source, DataFrame)
        raw = require_content(source, "dataset") if is_frame else load_dataset(self.spark, source, **options)
        raw, key = first_row_id(raw, key)
        data = clean.basic_clean(raw, key) if config.enable_basic_cleaning else nan_to_null(raw)
        data = cut_lineage(data)
        cols = [c for c in data.columns if c != key]
        profile = profiling.load_profile(profiling.column_profile(data, cols, key, config.max_sample_values))
        numeric, categorical = profile.names("numeric"), profile.names("categorical")
        report = Report(data, key, profile)

        report.correlations, report.dependencies = self._relations(data, numeric, categorical)
        report.strong_pairs = relate.strong_pairs(report.correlations, config.strong_correlation_threshold)
        report.clustering = self._segments(data, profile, key)
        report.anomalies, report.anomaly_methods = self._anomalies(data, numeric, key)
        if report.anomalies is not None:
            report.anomaly_summary = anomaly.anomaly_summary(report.anomalies, report.anomaly_methods)
        report.descriptive = self._statistics(data, profile)
        report.insights = self._insights(report)
        name = "dataset" if is_frame else str(source)
        elapsed = round(time.perf_counter() - start, 3)
        row = [(name, profile.n_rows, profile.n_cols, datetime.now().isoformat(timespec="seconds"), elapsed)]
        report.metadata = self.spark.createDataFrame(row, "source string, n_rows bigint, n_cols int, generated_at string, elapsed_seconds double")
        return report

    def analyze_many(self, sources: list[str], **options) -> dict[str, Report]:
        """A report per source, keyed by its path; sources that fail are left out."""
        reports = {}
        for source in sources:
            try:
                reports[str(source)] = self.analyze(str(source), **options)
            except UnknownMethodError:
                raise  # a wrong configuration fails for every source
            except TablescopeError as error:
                logger.warning("Skipped '%s': %s", source, error)
        return reports

    # ------------------------------------------------------------------ stages
    def _relations(self, data: DataFrame, numeric: list[str], categorical: list[str]) -> tuple[DataFrame, DataFrame]:
        config = self.config
        found = relate.correlations(data, numeric, config.correlation_methods)
        # one row per pair of columns; fixed here so that no later table repeats the work
        found = cut_lineage(found)
        return found, cut_lineage(relate.dependencies(data, categorical, numeric, config.dependency_threshold))

    def _segments(self, data: DataFrame, profile: profiling.Profile, key: str) -> cluster.Clustering | None:
        numeric = profile.names("numeric")
        if len(numeric) < 2 or profile.n_rows < self.config.min_rows_for_ml:
            return None
        try:
            scaled = cut_lineage(features.feature_frame(data, numeric, [key]))
            found = cluster.run_clustering(scaled, numeric, key, self.config)
            found.rows = cut_lineage(found.rows)
            return found
        except (TablescopeError, ValueError) as error:
            logger.warning("Clustering left out: %s", error)
            return None

    def _anomalies(self, data: DataFrame, numeric: list[str], key: str) -> tuple[DataFrame | None, list[str]]:
        if not numeric:
            return None, []
        imputed = features.impute_median(data, numeric, [key])
        flagged, methods = anomaly.detect_anomalies(imputed, numeric, key, self.config)
        return cut_lineage(flagged), methods

    def _statistics(self, data: DataFrame, profile: profiling.Profile) -> DataFrame | None:
        if self.provider is None:
            return None
        try:
            table = self.provider(data, profile)
            return cut_lineage(table) if table is not None else None
        except Exception as error:  # a user's provider must not stop the analysis
            logger.warning("Statistics left out: %s", error)
            return None

    def _insights(self, report: Report) -> DataFrame:
        parts = [insights.dataset_insight(report.profile.table), insights.missing_insights(report.profile.table)]
        parts.append(insights.correlation_insights(relate.distinct_pairs(report.strong_pairs)))
        parts.append(insights.dependency_insights(report.dependencies))
        if report.clustering is not None:
            parts.append(insights.clustering_insights(report.clustering_summary()))
        if report.anomaly_summary is not None:
            parts.append(insights.anomaly_insights(report.anomaly_summary))
        return insights.assemble(parts)
