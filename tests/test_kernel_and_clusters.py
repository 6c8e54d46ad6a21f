"""The exact kernel dual, joint k-means runs, plain silhouettes and cross-fitted probabilities against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsledger.models import clusters, kernel, margin


def frame(spark, x, **more):
    cols = [f"x{j}" for j in range(x.shape[1])]
    rows = [(i, *map(float, r), *[float(v[i]) for v in more.values()]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in [*cols, *more])), cols


@pytest.fixture(scope="module")
def waves(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(220, 2))
    return x, np.sin(2 * x[:, 0]) * 3 + x[:, 1] + rng.normal(size=220) * 0.2


@pytest.mark.parametrize("working, C", [(1000, 100.0), (60, 10.0)])
def test_kernel_dual_is_optimal(spark, waves, working, C):
    x, y = waves
    df, cols = frame(spark, x, y=y)
    model = kernel.fit_kernel_svr(df, cols, "y", C=C, working=working, gap=1e-4, tol=1e-4)
    z = (x - x.mean(0)) / x.std(0)
    held = {tuple(np.round(r["x"], 9)): r["beta"] for r in model.vectors.collect()}
    beta = np.array([held.get(tuple(np.round(v, 9)), 0.0) for v in z])
    f = kernel.kernel(z, z, 0.1) @ beta
    assert abs(beta.sum()) < 1e-8 and abs(beta).max() <= C + 1e-9
    primal = 0.5 * beta @ f + C * np.maximum(abs(y - f - model.bias) - 0.1, 0).sum()
    dual = y @ beta - 0.1 * abs(beta).sum() - 0.5 * beta @ f
    assert abs(primal - model.primal) < 1e-6 * primal and abs(dual - model.dual) < 1e-6 * primal
    assert model.converged and 0 <= model.gap <= 1e-3
    whole = kernel.solve_block(kernel.kernel(z, z, 0.1), y, np.zeros(len(y)), np.zeros(len(y)), C, 0.1, 1e-7)
    best = y @ whole - 0.1 * abs(whole).sum() - 0.5 * whole @ kernel.kernel(z, z, 0.1) @ whole
    assert dual <= best + 1e-6 * abs(best) and best - dual <= 1e-3 * abs(best)
    scored = kernel.predict_kernel(model, df).orderBy("id").toPandas()["prediction"].to_numpy()
    assert np.allclose(scored, f + model.bias, atol=1e-8)


def test_many_rows_of_few_features_are_solved_through_landmarks(spark, monkeypatch):
    """The steps do not grow with the support vectors; values are those of the whole kernel, also far from all rows."""
    monkeypatch.setattr(kernel, "SMALL_ROWS", 1000)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2500, 2))
    y = np.sin(2 * x[:, 0]) * 3 + x[:, 1] + rng.normal(size=2500)
    df, cols = frame(spark, x, y=y)
    model = kernel.fit_kernel_svr(df, cols, "y")
    assert model.converged and model.rounds < 40 and 0 <= model.gap <= 1e-3
    held = model.vectors.toPandas()
    z, beta = np.stack(held["x"]), held["beta"].to_numpy()
    assert len(z) == 2500 and abs(beta.sum()) < 1e-8 and abs(beta).max() <= 100.0
    K = kernel.kernel(z, z, 0.1)
    near = {tuple(np.round(v, 9)): t for v, t in zip((x - x.mean(0)) / x.std(0), y)}
    target, f = np.array([near[tuple(np.round(v, 9))] for v in z]), K @ beta
    primal = 0.5 * beta @ f + 100 * np.maximum(abs(target - f - model.bias) - 0.1, 0).sum()
    dual = target @ beta - 0.1 * abs(beta).sum() - 0.5 * beta @ f
    assert dual <= primal <= model.primal * (1 + 1e-9) and model.dual <= dual * (1 + 1e-9)
    far = df.limit(3).unionByName(spark.createDataFrame([(-1, 9.0, -7.0, 0.0)], df.schema))
    got = kernel.predict_kernel(model, far).toPandas()
    own = (got[cols].to_numpy() - x.mean(0)) / x.std(0)
    assert np.allclose(got["prediction"], kernel.kernel(own, z, 0.1) @ beta + model.bias, atol=1e-4)


def test_small_solves():
    a = np.random.default_rng(4).normal(size=(40, 40))
    a = a @ a.T + np.eye(40)
    assert np.allclose(a @ kernel._solve(kernel.lower(a), a[3]), a[3]) and kernel.lower(-a) is None


def test_kernel_parts_and_missing_rows(spark, waves, monkeypatch):
    x, y = waves
    df, cols = frame(spark, x, y=y)
    model = kernel.fit_kernel_svr(df, cols, "y", C=1.0)
    once = kernel.predict_kernel(model, df).orderBy("id").toPandas()["prediction"]
    monkeypatch.setattr(kernel, "PART", 30)
    monkeypatch.setattr(kernel, "BLOCK_ROWS", 50)
    odd = df.withColumn("x0", F.when(F.col("id") != 3, F.col("x0")))
    again = kernel.predict_kernel(model, odd).orderBy("id").toPandas()
    assert len(again) == len(x) - 1 and np.allclose(again["prediction"], once.drop(3))
    empty = kernel.fit_kernel_svr(df.limit(0), cols, "y")
    assert empty.vectors.count() == 0 and empty.bias == 0.0


def test_restarts_together_equal_restarts_alone(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([c + rng.normal(size=(80, 3)) * 0.4 for c in rng.normal(size=(5, 3)) * 3] + [np.zeros((20, 3))])
    df, cols = frame(spark, x)
    runs = clusters.fit_kmeans_runs(df, cols, 5, restarts=4, seed=7)
    for i in range(4):
        alone = clusters.fit_kmeans_runs(df, cols, 5, restarts=1, seed=7 + i)
        assert np.allclose(alone.centres[0], runs.centres[i]) and np.isclose(alone.inertia[0], runs.inertia[i]) and alone.rounds[0] == runs.rounds[i]
    assert runs.converged.all()
    for centres, cost in zip(runs.centres, runs.inertia):
        d2 = ((x[:, None] - centres[None]) ** 2).sum(2)
        assert np.isclose(d2.min(1).sum(), cost)
    labels = ((x[:, None] - runs.centres[runs.best][None]) ** 2).sum(2).argmin(1)
    spread = np.stack([x[labels == g].mean(0) for g in range(5)])
    assert np.allclose(spread, runs.centres[runs.best], atol=0.1)
    again = clusters.fit_kmeans_runs(df.repartition(9), cols, 5, restarts=4, seed=7)
    assert np.allclose(again.centres, runs.centres)


def test_fewer_points_than_clusters(spark):
    df, cols = frame(spark, np.array([[0.0, 0.0], [0.0, 0.0], [5.0, 5.0]]))
    assert clusters.fit_kmeans_runs(df, cols, 4, restarts=2).inertia.max() == 0.0
    with pytest.raises(ValueError):
        clusters.fit_kmeans_runs(df.limit(0), cols, 2, restarts=1)


@pytest.mark.parametrize("queries, points", [(2000, 20_000), (7, 11)])
def test_silhouette_of_plain_distances(spark, monkeypatch, queries, points):
    monkeypatch.setattr(clusters, "QUERY_ROWS", queries)
    monkeypatch.setattr(clusters, "POINT_ROWS", points)
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(40, 2)), rng.normal(size=(30, 2)) + 4, rng.normal(size=(1, 2)) - 9, np.zeros((9, 2))]).round(2)
    g = np.array([0] * 40 + [1] * 30 + [2] + [0] * 9)
    df, cols = frame(spark, x, g=g)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    s = []
    for i in range(len(x)):
        same = g == g[i]
        if same.sum() == 1:
            s.append(0.0)
            continue
        a, b = far[i, same].sum() / (same.sum() - 1), min(far[i, g == o].mean() for o in set(g) - {g[i]})
        s.append((b - a) / max(a, b))
    assert abs(clusters.silhouette(df, "g", cols, "euclidean") - np.mean(s)) < 1e-9
    part = clusters.silhouette(df, "g", cols, "euclidean", share=0.6)
    assert abs(part - np.mean(s)) < 0.3


def test_silhouette_sends_bytes_of_blocks_and_sums(spark, monkeypatch):
    """Points travel once a pair of blocks, sums without the numbers of their points: few rows, each a block of bytes."""
    monkeypatch.setattr(clusters, "QUERY_ROWS", 100)
    monkeypatch.setattr(clusters, "POINT_ROWS", 100)
    monkeypatch.setattr(clusters, "SUMS", 200)
    rng, kept = np.random.default_rng(4), []
    x, g = rng.normal(size=(400, 5)).astype(np.float32).astype(float), rng.integers(0, 3, 400)
    df, cols = frame(spark, x, g=g)
    write = clusters.cut_lineage
    monkeypatch.setattr(clusters, "cut_lineage", lambda d: kept.append(write(d)) or kept[-1])
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    means = np.stack([far[:, g == c].sum(1) / ((g == c).sum() - (g == c)) for c in range(3)], 1)
    a, others = means[np.arange(400), g], np.where(np.arange(3) == g[:, None], np.inf, means)
    b = others.min(1)
    assert abs(clusters.silhouette(df, "g", cols, "euclidean") - ((b - a) / np.maximum(a, b)).mean()) < 1e-9
    blocks = kept[-1].toPandas()
    assert len(blocks) == 4 and sum(map(len, blocks["x"])) == 400 * 5 * 4


def test_distances_by_products_keep_their_digits():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(60, 30)), rng.normal(size=(20, 30)) * 1e-9 + 1, np.zeros((2, 30))]) + 1e4
    plain = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert np.allclose(clusters.distances_to(x)(x), plain, rtol=1e-9, atol=0)


def test_both_sides_of_silhouettes_come_in_equal_blocks():
    """Copies sent grow with the larger number of blocks: 300,000 points meet as 15 x 15 blocks, not 150 x 15."""
    assert clusters.QUERY_ROWS >= clusters.POINT_ROWS


def test_probabilities_hold_on_rows_not_seen(spark):
    """Many features and few rows: training margins are too sure of themselves, unseen ones are not."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 25))
    y = (x[:, 0] + rng.normal(size=900) * 1.5 > 0).astype(float)
    df, cols = frame(spark, x, y=y)
    train, test = df.where("id < 120"), df.where("id >= 120")

    def loss(folds):
        weights, platt = margin.fit_classifier(train, cols, ["y"], folds=folds)
        assert {r["target"] for r in weights.collect()} == {"y"} and set(platt) == {"y"}
        out = margin.predict_classifier(test, weights, platt).select("y", "y_probability").toPandas()
        p = out["y_probability"].clip(1e-6, 1 - 1e-6)
        return float(-(out["y"] * np.log(p) + (1 - out["y"]) * np.log(1 - p)).mean())

    assert loss(5) < loss(1)
