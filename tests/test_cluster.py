import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescope.config import AnalysisConfig
from tablescope.errors import UnknownMethodError
from tablescope.functions import ordered, skew
from tablescope.functions.graph import connected_components
from tablescope.operators import blocks, cluster, dbscan, features


def brute_dbscan(points, eps, min_samples):
    distance = np.sqrt(sum((points[:, None, j] - points[None, :, j]) ** 2 for j in range(points.shape[1])))
    near = distance <= eps
    core = near.sum(axis=1) >= min_samples
    labels, current = -np.ones(len(points), int), 0
    for i in range(len(points)):
        if labels[i] != -1 or not core[i]:
            continue
        labels[i], stack = current, [i]
        while stack:
            at = stack.pop()
            if core[at]:
                for j in np.flatnonzero(near[at]):
                    if labels[j] == -1:
                        labels[j] = current
                        stack.append(j)
        current += 1
    return labels


def points_frame(spark, points):
    cols = [f"v{i}" for i in range(points.shape[1])]
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "k bigint, " + ", ".join(f"{c} double" for c in cols)), cols


def labels_of(df, cols, eps, min_samples=5):
    return dbscan.dbscan(df, cols, "k", eps, min_samples).toPandas().sort_values("k")["label"].to_numpy()


@pytest.mark.parametrize("d,n,eps,steps", [(1, 300, 0.02, 64), (2, 900, 0.15, 64), (2, 700, 0.4, 0), (3, 500, 0.5, 0), (5, 250, 1.4, 64)])
def test_dbscan_matches_a_scan_in_row_order(spark, monkeypatch, d, n, eps, steps):
    monkeypatch.setattr(dbscan, "STEPS_PER_ROW", steps)
    rng = np.random.default_rng(d)
    points = np.concatenate([rng.normal(0, 1, (n // 2, d)), rng.uniform(-3, 3, (n - n // 2, d))])[rng.permutation(n)]
    df, cols = points_frame(spark, points)
    assert (labels_of(df, cols, eps) == brute_dbscan(points, eps, 5)).all()


def test_dbscan_with_a_cell_holding_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "SMALL_ROWS", 10)
    monkeypatch.setattr(dbscan, "STEPS_PER_ROW", 0)
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(0, 0.01, (200, 2)), np.zeros((50, 2)), rng.uniform(-2, 2, (350, 2))])[rng.permutation(600)]
    df, cols = points_frame(spark, points)
    assert (labels_of(df, cols, 0.15) == brute_dbscan(points, 0.15, 5)).all()


def test_components(spark):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "node bigint")
    edges = spark.createDataFrame([(i + 1, i) for i in range(6)] + [(9, 8), (8, 9), (11, 11)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(7)}, 7: 7, 8: 8, 9: 8, 10: 10, 11: 11}


def plain_knee(values):
    n = len(values)
    line = values[0] + (values[-1] - values[0]) * np.arange(n) / (n - 1)
    return float(values[int(np.argmax(np.abs(line - values)))])


def test_knee(spark):
    knee = lambda v: dbscan.knee_value(spark.createDataFrame([(float(x),) for x in v], "k_distance double"))
    assert knee([]) == 0.5 and knee([1.0, 2.0]) == 2.0 and knee([1.0, 1.0, 1.0, 1.0, 9.0]) == 1.0
    values = np.sort(np.round(np.random.default_rng(1).exponential(1, 400), 2))
    assert knee(values[::-1]) == plain_knee(values)


@pytest.mark.parametrize("d, leaf", [(2, 2000), (2, 60), (5, 100)])
def test_eps_curve_is_exact(spark, d, leaf):
    points = np.round(np.random.default_rng(2).normal(0, 1, (300, d)), 2)
    points[:40] = points[0]
    df, cols = points_frame(spark, points)
    distance = np.sort(np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)), axis=1)[:, 4]
    got = dbscan.k_distances(df, cols, "k", 5, leaf).toPandas().sort_values("k")["k_distance"].to_numpy()
    assert len(got) == 300 and np.allclose(got, distance)
    assert dbscan.estimate_eps(df, cols, "k", 5, leaf) == pytest.approx(plain_knee(np.sort(distance)))


def test_curve_of_many_rows_has_them_all(spark):
    points = np.random.default_rng(3).normal(0, 1, (25_000, 2))
    df, cols = points_frame(spark, points)
    got = dbscan.k_distances(df, cols, "k", 5).toPandas().sort_values("k")["k_distance"].to_numpy()
    some = np.arange(0, 25_000, 500)
    distance = np.sort(np.sqrt(((points[some, None] - points[None]) ** 2).sum(axis=2)), axis=1)[:, 4]
    assert len(got) == 25_000 and np.allclose(got[some], distance)


def test_kmeans_finds_three_groups(spark, groups):
    scaled = features.feature_frame(groups, ["x", "y"], ["id"])
    found = cluster.run_clustering(scaled, ["x", "y"], "id", AnalysisConfig(kmeans_k_range=(2, 4)))
    assert found.n_clusters == 3 and found.params == {"k": 3} and found.silhouette > 0.5
    assert sorted(r["size"] for r in found.sizes.collect()) == [30, 30, 30]
    by_group = found.rows.join(groups.select("id", "grupo"), "id").groupBy("grupo").agg({"label": "min"}).collect()
    assert len({r["min(label)"] for r in by_group}) == 3
    again = cluster.kmeans(scaled, ["x", "y"], "id", 3).orderBy("id").select("label").collect()
    assert again == cluster.kmeans(scaled, ["x", "y"], "id", 3).orderBy("id").select("label").collect()


def test_silhouette_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points, labels = rng.normal(0, 1, (60, 2)), rng.integers(-1, 3, 60)
    labels[0] = 7  # a segment of one row scores 0
    df = spark.createDataFrame([(i, *map(float, p), int(g)) for i, (p, g) in enumerate(zip(points, labels))], "k bigint, a double, b double, label int")
    use = labels != -1
    p, g = points[use], labels[use]
    distance = np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2))
    scores = []
    for i in range(len(p)):
        own = (g == g[i]).sum() - 1
        if own == 0:
            scores.append(0.0)
            continue
        within = distance[i, g == g[i]].sum() / own
        outside = min(distance[i, g == o].mean() for o in set(g) - {g[i]})
        scores.append((outside - within) / max(within, outside))
    got, n = cluster.silhouettes(df, ["a", "b"], "k", ["label"])["label"]
    assert got == pytest.approx(np.mean(scores), abs=1e-9) and n == use.sum()
    monkeypatch.setattr(blocks, "LEAF_ROWS", 7)
    monkeypatch.setattr(blocks, "GRID_ROWS", 1)
    assert cluster.silhouettes(df, ["a", "b"], "k", ["label"])["label"][0] == pytest.approx(got, abs=1e-12)
    one = df.selectExpr("k", "a", "b", "0 AS label")
    assert cluster.silhouettes(one, ["a", "b"], "k", ["label"])["label"][0] is None


def test_dbscan_through_the_registry(spark, groups):
    scaled = features.feature_frame(groups, ["x", "y"], ["id"])
    found = cluster.run_clustering(scaled, ["x", "y"], "id", AnalysisConfig(clustering_algorithm="DBSCAN", dbscan_eps=0.5))
    assert found.n_clusters == 3 and found.params == {"eps": 0.5, "min_samples": 5} and found.rows.columns[-2:] == ["pc1", "pc2"]
    with pytest.raises(UnknownMethodError):
        cluster.run_clustering(scaled, ["x", "y"], "id", AnalysisConfig(clustering_algorithm="optics"))


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, None, 4.0), (3, 5.0, 4.0), (4, float("inf"), 4.0)], "id bigint, v double, k double")
    got = features.feature_frame(df, ["v", "k"], ["id"]).orderBy("id").toPandas()
    filled = np.array([1.0, 3.0, 5.0, 3.0])
    assert np.allclose(got["v"], (filled - 3) / filled.std()) and (got["k"] == 0).all()


@pytest.mark.parametrize("leaf_rows", [2000, 30])
def test_dbscan_in_eight_columns(spark, leaf_rows):
    rng = np.random.default_rng(12)
    centres = rng.uniform(-4, 4, (6, 8))
    points = np.concatenate([centres[rng.integers(0, 6, 500)] + rng.normal(0, 0.35, (500, 8)), rng.uniform(-5, 5, (150, 8))])[rng.permutation(650)]
    df, cols = points_frame(spark, points)
    got = dbscan.dbscan(df, cols, "k", 1.1, 5, leaf_rows).toPandas().sort_values("k")["label"].to_numpy()
    want = brute_dbscan(points, 1.1, 5)
    assert (got == want).all() and want.max() >= 5 and (want == -1).any()


def test_near_boxes_against_all_pairs_and_their_growth(spark):
    rng = np.random.default_rng(7)
    compared, centres = [], rng.uniform(0, 10, (40, 8))
    for n in (400, 3200):
        low = centres[rng.integers(0, 40, n)] + rng.normal(0, 0.3, (n, 8))
        high = low + rng.uniform(0, 0.2, (n, 8))
        names = "id bigint, " + ", ".join(f"lo{i} double, hi{i} double" for i in range(8))
        df = spark.createDataFrame([(i, *map(float, np.stack([a, b], axis=1).ravel())) for i, (a, b) in enumerate(zip(low, high))], names)
        if n == 400:
            got = blocks.near_boxes(df, 8, 0.5, 80).toPandas()
            apart = np.maximum(0, np.maximum(low[:, None] - high[None], low[None] - high[:, None]))
            want = np.argwhere(np.sqrt((apart**2).sum(axis=2)) <= 0.5)
            assert sorted(zip(got.a, got.b)) == sorted(map(tuple, want.tolist()))
        placed, bits = blocks.tree(df.select("id", *[F.col(f"lo{i}").alias(f"x{i}") for i in range(8)], *[f"{e}{i}" for i in range(8) for e in ("lo", "hi")]), 8, 40)
        sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
        leaves = placed.groupBy("leaf").agg(*[f(f"{e}{i}").alias(f"{e}{i}") for i in range(8) for e, f in (("lo", F.min), ("hi", F.max))]).withColumn("bound", F.lit(0.5))
        compared.append(sum(sizes[i] * sizes[j] for i, j in blocks.leaf_pairs(leaves, bits, 8).collect()))
    assert compared[1] < compared[0] * 64 / 2  # eight times the boxes, sixty-four times the pairs


def test_leaves_of_uneven_columns_are_small(spark):
    """Five of six columns hold zeros in 95 of 100 rows."""
    rng = np.random.default_rng(5)
    points = rng.normal(0, 1, (32_000, 6)) * np.concatenate([np.ones((32_000, 1)), rng.random((32_000, 5)) < 0.05], axis=1)
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], ", ".join(f"x{i} double" for i in range(6)))
    placed, bits = blocks.tree(df, 6, 1000)
    sizes = [r["count"] for r in placed.groupBy("leaf").count().collect()]
    assert sum(sizes) == 32_000 and max(sizes) <= 1000 and np.mean(sizes) > 250 and bits <= 12
    sparse = (rng.random((4000, 12)) < 0.05) * rng.integers(1, 9, (4000, 12))
    sparse = np.unique(sparse, axis=0)
    placed, _ = blocks.tree(spark.createDataFrame([tuple(map(float, p)) for p in sparse], ", ".join(f"x{i} double" for i in range(12))), 12, 50)
    assert max(r["count"] for r in placed.groupBy("leaf").count().collect()) <= 50


def test_curve_of_uneven_columns(spark):
    rng = np.random.default_rng(6)
    points = np.round(rng.normal(0, 1, (900, 4)), 1) * np.concatenate([np.ones((900, 1)), rng.random((900, 3)) < 0.1], axis=1)
    df, cols = points_frame(spark, points)
    distance = np.sort(np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)), axis=1)
    for k in (1, 60):
        got = dbscan.k_distances(df, cols, "k", k, 200).toPandas().sort_values("k")["k_distance"].to_numpy()
        assert np.allclose(got, distance[:, k - 1])


def test_knee_of_a_curve_with_one_far_value(spark):
    values = np.sort(np.append(np.random.default_rng(2).exponential(1, 3000), 1e6))
    curve = spark.createDataFrame([(float(x),) for x in values], "k_distance double")
    assert dbscan.knee_value(curve) == plain_knee(values)
    places = ordered.rank_table(curve.select(F.lit(0).alias("v"), F.col("k_distance").alias("value")), dbscan.KNEE_RANGES)
    assert places.count() == 3001 and places.agg(F.max("before")).first()[0] == 3000
    ranged = curve.repartitionByRange(dbscan.KNEE_RANGES, "k_distance").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert ranged.max() <= 3001 / 50


def test_copies_of_a_row_grow_with_the_root(spark, monkeypatch):
    """Four times the rows, eight times the shuffled rows, same sums."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(blocks, "LEAF_ROWS", 10)
    monkeypatch.setattr(blocks, "GRID_ROWS", 2)
    for n in (100, 400):
        points = rng.normal(0, 1, (n, 3))
        labels = rng.integers(-1, 2, n)
        df = spark.createDataFrame([(*map(float, p), int(g)) for p, g in zip(points, labels)], "a double, b double, c double, g int")
        got = np.array([r["sums"] for r in blocks.distance_sums(df, ["a", "b", "c"], {"g": 2}).collect()])
        distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
        want = np.stack([distance[:, labels == g].sum(axis=1) for g in (0, 1)], axis=1)
        assert np.allclose(np.sort(got, axis=0), np.sort(want, axis=0))


def test_components_of_long_paths_at_every_size(spark):
    rng = np.random.default_rng(1)
    names = rng.permutation(3000)
    pairs = [(int(names[i]), int(names[i + 1])) for i in range(2999) if i % 1000 != 999]
    nodes = spark.createDataFrame([(int(i),) for i in range(3000)], "node bigint")
    edges = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(7)
    want = {int(x): int(names[i // 1000 * 1000 : i // 1000 * 1000 + 1000].min()) for i, x in enumerate(names)}
    for one_task in (1_000_000, 50):
        assert {r["node"]: r["root"] for r in connected_components(nodes, edges, one_task).collect()} == want


def test_dbscan_of_rows_named_by_text(spark):
    rows = [(f"r{i}", float(i % 3 * 10) + i / 100) for i in range(30)] + [("x", 99.0)]
    got = dbscan.dbscan(spark.createDataFrame(rows, "name string, v double"), ["v"], "name", 1.0, 5).toPandas().set_index("name").label
    assert got["x"] == -1 and got["r0"] == 0 and set(got) == {-1, 0, 1, 2} and len(got) == 31


@pytest.mark.parametrize("d", [1, 2])
def test_distance_sums_through_the_tree(spark, monkeypatch, d):
    """Rows in groups, on lines, far away and equal: the sums are those of all pairs, from a fraction of the pairs."""
    rng = np.random.default_rng(d)
    spots = np.concatenate([rng.normal(0, 1, (1500, d)), rng.normal(0, 1e-3, (500, d)) + 3, np.stack([rng.uniform(-5, 5, 700), np.full(700, 2.0)], axis=1)[:, :d], np.full((200, d), 7.0), np.full((1, d), 1e4)])
    labels = rng.integers(-1, 3, (len(spots), 2))
    monkeypatch.setattr(blocks, "DIRECT_ROWS", 100)
    monkeypatch.setattr(blocks, "NEAR_ROWS", 30)
    met, plain = [], blocks._meetings
    monkeypatch.setattr(blocks, "_meetings", lambda *a: met.append(plain(*a)) or met[-1])
    names = ["a", "b"][:d]
    df = spark.createDataFrame([(*map(float, p), *map(int, g)) for p, g in zip(spots, labels)], ", ".join(f"{c} double" for c in names) + ", g int, h int")
    got = blocks.distance_sums(df, names, {"g": 3, "h": 3}).collect()
    assert len(met) == 1 and len(met[0][1]) < 0.5 * len(np.unique(met[0][1])) ** 2
    assert sum(r["n"] for r in got) == len(spots)
    distance = np.sqrt(((spots[:, None] - spots[None]) ** 2).sum(axis=2))
    want = np.concatenate([np.stack([distance[:, labels[:, k] == g].sum(axis=1) for g in range(3)], axis=1) for k in (0, 1)], axis=1)
    order = lambda table: table[np.lexsort(np.round(table, 5).T)]
    assert np.allclose(order(np.repeat([r["sums"] for r in got], [r["n"] for r in got], axis=0)), order(want), rtol=1e-10, atol=0)


def test_distances_of_many_columns_keep_their_digits():
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (40, 64))
    y = np.concatenate([x, x + 1e-7, rng.normal(0, 1, (20, 64))])
    want = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    assert np.allclose(blocks._pair_distances(x, y), want, rtol=1e-10, atol=0)


def test_silhouette_of_nine_columns(spark):
    """Equal rows and rows far from the origin."""
    rng = np.random.default_rng(5)
    points, labels = np.concatenate([rng.normal(0, 1, (80, 9)), np.ones((20, 9))]) + 1e3, rng.integers(0, 2, 100)
    cols = [f"v{i}" for i in range(9)]
    df = spark.createDataFrame([(i, *map(float, p), int(g)) for i, (p, g) in enumerate(zip(points, labels))], "k bigint, " + ", ".join(f"{c} double" for c in cols) + ", label int")
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    sums = np.stack([distance[:, labels == g].sum(axis=1) for g in (0, 1)], axis=1)
    size, at = np.bincount(labels), np.arange(100)
    within, outside = sums[at, labels] / (size[labels] - 1), sums[at, 1 - labels] / size[1 - labels]
    assert cluster.silhouettes(df, cols, "k", ["label"])["label"][0] == pytest.approx(np.mean((outside - within) / np.maximum(outside, within)), abs=1e-10)
