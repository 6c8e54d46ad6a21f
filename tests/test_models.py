import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsledger.models import bayes, clusters, density, isolation, margin, regress
from obsledger.models.scale import fit_scaler, scale


def frame(spark, x, **more):
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(x.shape[1])]).assign(**more)
    pdf.insert(0, "id", np.arange(len(pdf)))
    return spark.createDataFrame(pdf)


def cols(x):
    return [f"x{i}" for i in range(x.shape[1])]


# ---- scaler, naive Bayes -------------------------------------------------------------

def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = scale(df, fit_scaler(df, ["a", "b"])).orderBy("a").collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_bayes_against_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.2] + y[:, None] * [1.0, -2.0, 0.1]
    df = frame(spark, x, y=y)
    got = bayes.predict_bayes(df, bayes.fit_bayes(df.repartition(7), cols(x), "y"), cols(x)).orderBy("id").toPandas()
    eps = 1e-9 * x.var(0).max()
    ll = np.stack([
        np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + eps)) + (x - x[y == c].mean(0)) ** 2
                                         / (x[y == c].var(0) + eps)).sum(1) for c in (0, 1)])
    p = 1 / (1 + np.exp(ll[0] - ll[1]))
    assert np.allclose(got["probability"], p) and (got["prediction"] == (p > 0.5)).all()


def test_bayes_with_one_class(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "x double, y int")
    assert {r["prediction"] for r in bayes.predict_bayes(df, bayes.fit_bayes(df, ["x"], "y"), ["x"]).collect()} == {1}


def test_next_day_of_a_date_without_rows(spark, sf):
    from obsledger.queries.forecasts import STATION
    from obsledger.queries.frames import daily
    rows = daily(spark, sf).withColumn("y", (F.col("rain_today") == "Yes").cast("int"))
    params = bayes.fit_bayes(rows, ["total", "top"], "y")
    assert bayes.predict_next_day(rows, params, ["total", "top"], STATION, "1990-01-01").isEmpty()
    assert not bayes.predict_rows(rows, params, ["total", "top"]).isEmpty()


# ---- regression ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def line():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    return x, x @ [2.0, -1.0, 0.5] + 1 + rng.standard_t(2, 600) * 0.5


def test_ols_residuals_are_orthogonal(spark, line):
    x, y = line
    df = frame(spark, x, y=y)
    model = regress.fit_regressor(df, cols(x), "y")
    out = regress.predict(model, df).orderBy("id").toPandas()
    r = out["y"].to_numpy() - out["prediction"].to_numpy()
    assert np.abs(x.T @ r).max() < 1e-6 and abs(r.sum()) < 1e-6
    terms = {t["term"]: t["value"] for t in regress.coefficients(model, spark).collect()}
    assert set(terms) == {"intercept", *cols(x)}


def test_deep_tree_reproduces_training_rows(spark):
    df = spark.range(60).select("id", F.col("id").cast("double").alias("x0"), (F.col("id") % 7).cast("double").alias("y"))
    out = regress.predict(regress.fit_regressor(df, ["x0"], "y", "tree"), df)
    assert out.where("abs(y - prediction) > 1e-9").isEmpty()


def test_forest_of_a_large_frame_does_not_hang_on_arrival(spark, line, monkeypatch):
    monkeypatch.setattr(regress, "ORDERED_ROWS", 500)
    x, y = line
    ways = [frame(spark, x[at], y=y[at]).drop("id").coalesce(1) for at in (np.arange(600), np.arange(600)[::-1])]
    models = [regress.fit_regressor(df, cols(x), "y", "forest", numTrees=5, maxDepth=4) for df in ways]
    assert models[0].stages[-1].toDebugString.split("\n", 1)[1] == models[1].stages[-1].toDebugString.split("\n", 1)[1]
    assert regress.predict(models[0], ways[0]).count() == 600


def test_order_of_a_large_frame(spark, monkeypatch):
    monkeypatch.setattr(regress, "ORDERED_ROWS", 500)
    df = spark.range(900).select((F.col("id") * 7 % 900).cast("double").alias("many"), (F.col("id") % 3).alias("few"), F.lit(1.0).alias("y"))
    got = [tuple(r) for r in regress.neighbours(df.coalesce(1), ["many", "few"], "y").select("few", "many").collect()]
    assert got == sorted(got) and len(got) == 900
    small = df.limit(400)
    assert regress.neighbours(small, ["many", "few"], "y") is small


def test_unknown_regressor_is_refused(spark):
    with pytest.raises(ValueError):
        regress.fit_regressor(spark.range(1), [], "id", "knn")
    with pytest.raises(ValueError):
        regress.fit_from_params(spark.range(1), "id", {"model_type": "Ridge"})


def test_svr_reaches_the_minimum(spark, line):
    x, y = line

    def objective(w):
        return 0.5 * (w[:3] ** 2).sum() + np.maximum(0, np.abs(x @ w[:3] + w[3] - y) - 0.1).sum()

    def subgradient(w):
        r = x @ w[:3] + w[3] - y
        s = np.where(np.abs(r) > 0.1, np.sign(r), 0)
        return np.r_[w[:3] + s @ x, s.sum()]

    w = start = np.linalg.lstsq(np.c_[x, np.ones(len(y))], y, rcond=None)[0]
    best = objective(w)
    for k in range(8000):
        w = w - 0.1 / np.sqrt(k + 1) * subgradient(w) / len(y)
        best = min(best, objective(w))
    df = frame(spark, x, y=y)
    got = {r["feature"]: r["weight"] for r in margin.fit_svr(df, cols(x), "y").collect()}
    ours = objective(np.array([got["x0"], got["x1"], got["x2"], got["(bias)"]]))
    assert ours <= best * 1.01 and ours <= objective(start)


def test_rounds_of_a_fit_pass_over_blocks(spark, line, monkeypatch):
    x, y = line
    df = frame(spark, np.tile(x, (20, 1)), y=np.tile(y, 20)).withColumn("flag", (F.col("y") > 1).cast("int"))
    handed, add_up = [], margin.sum_batches

    def counted(rows, *how):
        handed.append(rows.count())
        return add_up(rows, *how)

    monkeypatch.setattr(margin, "sum_batches", counted)
    margin.fit_svr(df, cols(x), "y", max_iter=2)
    margin.fit_classifier(df, cols(x), ["flag"], max_iter=2)
    assert len(handed) > 10 and max(handed) <= 12  # 12,000 rows


def test_packed_blocks_give_back_the_rows(spark):
    rows = [([float(i), -float(i)], [None if i % 3 == 0 else float(i % 2)]) for i in range(50)]
    df = spark.createDataFrame(rows, "x array<double>, y array<double>").repartition(4)
    for labels in (False, True):
        got = []
        for b in margin.packed(df, (2, 1), 50, labels).toArrow().to_batches():
            got += [(*a, *c) for x, y in margin._blocks(b, (2, 1), labels) for a, c in zip(x.tolist(), y.tolist())]
        got.sort()
        assert [g[:2] for g in got] == [tuple(x) for x, _ in rows]
        assert np.array_equal([g[2] for g in got], [np.nan if y[0] is None else y[0] for _, y in rows], equal_nan=True)


def test_rounds_leave_out_settled_targets(spark):
    df = spark.createDataFrame([([float(i)], [float(i % 5), None if i % 4 else 1.0]) for i in range(40)], "x array<double>, y array<double>")
    obj = margin._Objective(margin.packed(df, (1, 2), 40), 1, 2, "eps", 1.0, 0.1)
    W, n = np.array([[0.1, 1.0], [0.2, 0.0]]), np.array([40.0, 10.0])
    every, one = obj.evaluate(W, n, 0.5), obj.evaluate(W, n, 0.5, np.array([False, True]))
    assert all(np.allclose(a[1], b[1]) for a, b in zip(every, one)) and np.isinf(one[0][0])
    r = W[1, 0] * np.arange(0, 40, 4) - 1
    over = np.maximum(np.abs(r) - 0.1, 0)
    assert np.isclose(every[0][1], (0.5 * 0.2 ** 2 + np.where(over < 0.5, over ** 2, over - 0.25).sum()) / 10)


def test_margin_masks_missing_targets_and_skips_empty_ones(spark, line):
    x, y = line
    df = frame(spark, x, y=y).withColumn("half", F.when(F.col("id") % 2 == 0, F.col("y"))).withColumn(
        "none", F.lit(None).cast("double"))
    both = margin.weights_of(margin.fit_margin(df, cols(x), ["y", "half", "none"]))
    assert set(both) == {"y", "half"}
    alone = margin.fit_margin(df.where("id % 2 = 0"), cols(x), ["y"])
    out = margin.predict_margin(margin.predict_margin(df, alone, "_alone"), margin.fit_margin(df, cols(x), ["y", "half"]), "_hat")
    assert out.agg(F.max(F.abs(F.col("y_alone") - F.col("half_hat")))).first()[0] < 0.05


def test_classifier_probabilities(spark, line):
    x, _ = line
    y = (x[:, 0] + x[:, 1] > 0.5).astype(float)
    df = frame(spark, x, y=y).withColumn("same", F.lit(1.0))
    weights, platt = margin.fit_classifier(df, cols(x), ["y", "same"])
    assert list(platt) == ["y"]  # a label with one class gets no model
    out = margin.predict_classifier(df, weights, platt).toPandas()
    assert ((out["y_probability"] > 0.5) == (out["y"] > 0)).mean() > 0.97
    assert out["y_probability"].between(0, 1).all()


def test_kernel_svr_beats_the_line_on_a_curve(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-2, 2, size=(500, 1))
    y = np.sin(3 * x[:, 0])
    df = frame(spark, x, y=y)
    out = margin.fit_kernel_svr(df, ["x0"], "y", gamma=1.0, n_features=48, max_iter=4)(df).toPandas()
    assert ((out["y"] - out["prediction"]) ** 2).mean() < 0.2 * y.var()


# ---- density clusters --------------------------------------------------------------------

def brute_dbscan(x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core, label, c = near.sum(1) >= least, -np.ones(len(x), int), 0
    for i in range(len(x)):
        if label[i] == -1 and core[i]:
            label[i], todo = c, [i]
            while todo:
                for k in np.flatnonzero(near[todo.pop()]):
                    if label[k] == -1:
                        label[k] = c
                        if core[k]:
                            todo.append(k)
            c += 1
    return label


@pytest.mark.parametrize("p,eps,cell_points", [(1, 0.01, 20000), (2, 0.15, 20000), (2, 0.15, 10), (3, 0.4, 20000), (5, 0.9, 20000)])
def test_dbscan_equals_brute_force(spark, monkeypatch, p, eps, cell_points):
    monkeypatch.setattr(density, "CELL_POINTS", cell_points)
    rng = np.random.default_rng(p)
    x = np.vstack([rng.normal(c, 0.25, (80, p)) for c in (0, 1.2, 3)] + [np.zeros((60, p))])
    x = np.round(x[rng.permutation(len(x))], 3)
    got = density.dbscan(frame(spark, x), "id", cols(x), eps, 5).select("id", "dbscan_cluster", "is_anomaly").toPandas()
    got = got.sort_values("id")
    assert len(got) == len(x)
    assert (got["dbscan_cluster"].to_numpy() == brute_dbscan(x, eps, 5)).all()
    assert ((got["dbscan_cluster"] == -1) == (got["is_anomaly"] == 1)).all()


def test_components_of_a_long_chain(spark):
    n = 200
    edges = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).where("u <> 120")
    nodes = spark.range(n).select(F.col("id").alias("node"))
    got = {r["node"]: r["root"] for r in density.components(edges, nodes).collect()}
    assert all(got[i] == (0 if i <= 120 else 121) for i in range(n))


# ---- k-means, components, isolation ----------------------------------------------------------

def test_kmeans_inertia_falls_with_k_and_ids_are_ordered(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.2, (60, 2)) for c in (0, 3, 6)])
    df = frame(spark, x)
    costs = []
    for k in (2, 3):
        centres, cost = clusters.fit_kmeans(df, cols(x), k, restarts=2)
        costs.append(cost)
    assert costs[0] > costs[1]
    first = [r["x0"] for r in centres.orderBy("cluster").collect()]
    assert first == sorted(first)
    assigned = clusters.assign(df, centres, cols(x))
    assert clusters.inertia(assigned).first()[0] == pytest.approx(costs[1], rel=1e-6)
    assert clusters.silhouette(assigned, "cluster", cols(x)) > 0.9
    assert clusters.silhouette(assigned.withColumn("one", F.lit(0)), "one", cols(x)) == 0.0


def test_pca_against_eigen(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + 7
    df = frame(spark, x)
    loadings, variance = clusters.fit_pca(df, cols(x), 3)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    got = [r["explained_ratio"] for r in variance.orderBy("component").collect()]
    assert np.allclose(got, (values / values.sum())[:3])
    scores = clusters.project(df, loadings).select("PC1", "PC2", "PC3").toPandas().to_numpy()
    assert np.allclose(scores.mean(0), 0, atol=1e-9) and np.allclose(scores.var(0, ddof=1), values[:3])
    top = loadings.groupBy("component").agg(F.max_by("loading", F.abs("loading")).alias("v")).collect()
    assert all(r["v"] > 0 for r in top)


def test_isolation_forest_finds_planted_rows(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(950, 2)), rng.normal(9, 0.5, size=(10, 2))])
    df = frame(spark, x)
    forest = isolation.fit_iforest(df, ["id"], cols(x), trees=50)
    assert forest.groupBy("tree").count().agg(F.max("count")).first()[0] <= 511
    out = isolation.detect(df, forest, cols(x), 0.05)
    again = isolation.detect(df.repartition(6), isolation.fit_iforest(df.repartition(3), ["id"], cols(x), trees=50), cols(x), 0.05)
    assert out.where("id >= 950").agg(F.min("is_anomaly")).first()[0] == 1
    assert 38 <= out.agg(F.sum("is_anomaly")).first()[0] <= 58
    assert out.select("id", "is_anomaly").exceptAll(again.select("id", "is_anomaly")).isEmpty()


def test_isolation_forest_with_few_rows(spark):
    x = np.arange(12, dtype=float).reshape(6, 2)
    forest = isolation.fit_iforest(frame(spark, x), ["id"], cols(x), trees=3)
    assert {r["sample"] for r in forest.select("sample").collect()} == {6}
