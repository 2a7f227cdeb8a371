"""K-Means and DBSCAN segments with Euclidean silhouette and a 2-D view."""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.sql import Column, DataFrame, functions as F

from ..config import AnalysisConfig
from ..errors import UnknownMethodError
from ..functions.values import col
from .blocks import distance_sums
from .dbscan import dbscan, estimate_eps
from .features import project_2d, with_vectors
from .sampling import hash_sample

RESTARTS = 10
PARALLEL_FITS = 8
MAX_ITERATIONS = 300


@dataclass
class Clustering:
    """Row table ``(key, label, pc1, pc2)``, segment sizes and the figures of the run."""

    algorithm: str
    rows: DataFrame
    features: list[str]
    n_clusters: int
    sizes: DataFrame
    silhouette: float | None
    silhouette_rows: int
    params: dict = field(default_factory=dict)


def _fit_best(vectors: DataFrame, ks: list[int], seed: int, restarts: int) -> dict[int, object]:
    """Per k the cheapest of several K-Means fits, run side by side."""
    def fit(task):
        k, s = task
        return k, KMeans(k=k, seed=seed + s, maxIter=MAX_ITERATIONS, tol=1e-4, featuresCol="_features").fit(vectors)

    tasks = [(k, s) for k in ks for s in range(restarts)]
    with ThreadPool(min(PARALLEL_FITS, len(tasks))) as pool:
        fitted = pool.map(inheritable_thread_target(vectors.sparkSession)(fit), tasks)
    best: dict[int, object] = {}
    for k, model in fitted:
        if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = model
    return best


def _assign(vectors: DataFrame, model, name: str) -> DataFrame:
    """Cluster numbers in order of size, then of centre, from 0."""
    sizes, centres = model.summary.clusterSizes, model.clusterCenters()
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], tuple(centres[i])))
    rank = {old: new for new, old in enumerate(order)}
    numbers = F.array(*[F.lit(rank[i]) for i in range(len(sizes))])
    model = model.copy()
    model.setPredictionCol("_raw")
    return model.transform(vectors).withColumn(name, F.element_at(numbers, F.col("_raw") + 1)).drop("_raw")


def kmeans(scaled: DataFrame, cols: list[str], key: str, k: int, seed: int = 42, restarts: int = RESTARTS) -> DataFrame:
    """``(key, *cols, label)`` from the best of several k-means|| starts."""
    vectors = with_vectors(scaled, cols).persist()
    try:
        n_rows = vectors.count()
        k = max(2, min(k, n_rows - 1))
        model = _fit_best(vectors.select("_features"), [k], seed, restarts)[k]
    finally:
        vectors.unpersist()
    return _assign(with_vectors(scaled, cols), model, "label").select(col(key), *[col(c) for c in cols], "label")


def choose_k(
    scaled: DataFrame, cols: list[str], key: str, k_range: tuple[int, int] = (2, 10), seed: int = 42,
    restarts: int = RESTARTS, sample_rows: int | None = None,
) -> tuple[int, dict[int, float]]:
    """k with the highest Euclidean silhouette, the smallest on ties; 2 by default.

    Every row takes part; a caller who cannot afford the silhouette of many
    columns, which is quadratic, names a ``sample_rows``, which then holds at
    any size.
    """
    rows = hash_sample(scaled, key, sample_rows, seed)
    n_rows = rows.count()
    ks = list(range(max(2, k_range[0]), min(k_range[1], n_rows - 1) + 1))
    if not ks:
        return 2, {}
    vectors = with_vectors(rows, cols).persist()
    try:
        models = _fit_best(vectors.select("_features"), ks, seed, restarts)
        labelled = vectors
        for k in ks:
            labelled = _assign(labelled, models[k], f"label_{k}")
        found = silhouettes(labelled.drop("_features"), cols, key, [f"label_{k}" for k in ks])
    finally:
        vectors.unpersist()
    scores = {k: found[f"label_{k}"][0] for k in ks if found[f"label_{k}"][0] is not None}
    return max(scores, key=lambda k: (scores[k], -k), default=2), scores


def silhouettes(
    labelled: DataFrame, cols: list[str], key: str, label_cols: list[str], sample_rows: int | None = None, seed: int = 42
) -> dict[str, tuple[float | None, int]]:
    """Mean Euclidean silhouette and rows used, for several labellings at once.

    Noise (-1) is left out.  One or two columns take time that grows with the
    rows; with more of them every row meets every row, which is quadratic.
    With ``sample_rows`` the score is an estimate over a hash sample of about
    that many rows.
    """
    rows = hash_sample(labelled, key, sample_rows, seed)
    counts = {c: {r[0]: r[1] for r in rows.groupBy(col(c)).count().collect()} for c in label_cols}  # one row per group
    result: dict[str, tuple[float | None, int]] = {}
    numbers: dict[str, list] = {}
    for c, sizes in counts.items():
        names = sorted(n for n in sizes if n is not None and n != -1)
        kept = sum(sizes[n] for n in names)
        if len(names) < 2 or kept <= len(names):
            result[c] = (None, kept)
        else:
            numbers[c] = names
    if not numbers:
        return result

    def number(c: str) -> Column:
        pairs = [F.lit(x) for i, n in enumerate(numbers[c]) for x in (n, i)]
        return F.coalesce(F.create_map(*pairs)[col(c)], F.lit(-1)).alias(f"_g{list(numbers).index(c)}")

    groups = {f"_g{i}": len(names) for i, names in enumerate(numbers.values())}
    sums = distance_sums(rows.select(*[col(c) for c in cols], *[number(c) for c in numbers]), cols, groups)
    start, cells = 0, []
    for i, (c, names) in enumerate(numbers.items()):
        own, sizes = F.col(f"_g{i}"), [counts[c][n] for n in names]
        size = F.element_at(F.array(*[F.lit(float(s)) for s in sizes]), own + 1)
        within = F.element_at("sums", own + 1 + start) / F.greatest(size - 1, F.lit(1.0))
        means = [F.when(own != j, F.element_at("sums", start + j + 1) / float(s)) for j, s in enumerate(sizes)]
        other = F.array_min(F.array(*means))
        top = F.greatest(within, other)
        value = F.when((size > 1) & (top > 0), (other - within) / top).otherwise(0.0)
        cells.append((F.sum(F.when(own >= 0, value * F.col("n"))) / F.sum(F.when(own >= 0, F.col("n")))).alias(f"s{i}"))
        start += len(names)
    row = sums.agg(*cells).first()
    for i, (c, names) in enumerate(numbers.items()):
        result[c] = (row[i], sum(counts[c][n] for n in names))
    return result


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    """``(label, size)``, noise included as -1."""
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("size"))


def segment_ranking(sizes: DataFrame) -> DataFrame:
    """Segments by size, then label; noise is not a segment."""
    return sizes.filter(F.col("label") != -1).orderBy(F.col("size").desc(), "label")


def segment_overview(sizes: DataFrame) -> DataFrame:
    """One row: number of segments, size of the largest, noise rows and their share."""
    noise = F.coalesce(F.sum(F.when(F.col("label") == -1, F.col("size"))), F.lit(0))
    return sizes.agg(
        F.count(F.when(F.col("label") != -1, 1)).alias("n_clusters"),
        F.coalesce(F.max(F.when(F.col("label") != -1, F.col("size"))), F.lit(0)).alias("largest"),
        noise.alias("noise"),
        (noise / F.sum("size")).alias("noise_share"),
    )


def _run_kmeans(scaled, cols, key, config):
    k = config.kmeans_k or choose_k(scaled, cols, key, config.kmeans_k_range, config.random_state)[0]
    n_rows = scaled.count()
    k = max(2, min(k, n_rows - 1))
    return kmeans(scaled, cols, key, k, config.random_state), {"k": k}


def _run_dbscan(scaled, cols, key, config):
    eps = config.dbscan_eps or estimate_eps(scaled, cols, key, config.dbscan_min_samples)
    labels = dbscan(scaled, cols, key, eps, config.dbscan_min_samples)
    rows = scaled.join(labels, key).select(col(key), *[col(c) for c in cols], "label")
    return rows, {"eps": round(float(eps), 4), "min_samples": config.dbscan_min_samples}


ALGORITHMS = {"kmeans": _run_kmeans, "dbscan": _run_dbscan}


def run_clustering(scaled: DataFrame, cols: list[str], key: str, config: AnalysisConfig | None = None) -> Clustering:
    """The configured algorithm on scaled rows."""
    config = config or AnalysisConfig()
    name = config.clustering_algorithm.lower()
    if name not in ALGORITHMS:
        raise UnknownMethodError(f"Unknown clustering algorithm '{name}'; options: {', '.join(ALGORITHMS)}.")
    labelled, params = ALGORITHMS[name](scaled, cols, key, config)
    rows = project_2d(labelled, cols)
    sizes = cluster_sizes(labelled)
    n_clusters = segment_overview(sizes).first()["n_clusters"]
    score, used = silhouettes(labelled, cols, key, ["label"])["label"]
    return Clustering(name, rows, list(cols), n_clusters, sizes, score, used, params)
