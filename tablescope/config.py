"""Settings of one analysis run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class AnalysisConfig:
    """Every knob of the analysis; the defaults need no tuning."""

    # ---- fixed values: names and defaults of the options
    correlation_methods: list[str] = field(default_factory=lambda: ["pearson", "spearman"])
    strong_correlation_threshold: float = 0.7
    dependency_threshold: float = 0.14

    clustering_algorithm: str = "kmeans"
    kmeans_k: int | None = None
    kmeans_k_range: tuple[int, int] = (2, 10)
    dbscan_eps: float | None = None
    dbscan_min_samples: int = 5

    anomaly_methods: list[str] = field(default_factory=lambda: ["zscore", "iqr", "isolation_forest"])
    zscore_threshold: float = 3.0
    iqr_multiplier: float = 1.5
    isolation_contamination: float | str = "auto"

    random_state: int = 42
    enable_basic_cleaning: bool = True
    max_sample_values: int = 5
    min_rows_for_ml: int = 5
