"""Models: standardising, naive Bayes, least squares, trees, margins, clusters, components, isolation."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions.scalars import yesno_to_int
from obsledger.models import bayes, clusters, density, isolation, kernel, margin, regress, trees
from obsledger.models.scale import fit_scaler, scale
from obsledger.operators import clean as C
from obsledger.operators.evaluate import regression_metrics
from obsledger.operators.timeline import hash_split
from obsledger.plans.prepare import risk_features
from obsledger.plans.risk import risk_by_bayes
from obsledger.queries import query
from obsledger.queries.forecasts import STATION
from obsledger.queries.frames import DAILY, OBS, daily, observations, rounded, table

KEY = "orderkey, linenumber, partkey, supplier, d"
_KEYS = KEY.split(", ")
_DAY = ["station", "d"]


@query("standardize", f"""WITH {OBS}, i AS (SELECT {KEY}, coalesce(quantity, (SELECT median(quantity) FROM obs)) AS quantity, discount, tax FROM obs),
s AS (SELECT avg(quantity) AS mq, stddev_pop(quantity) AS sq, avg(discount) AS md, stddev_pop(discount) AS sd, avg(tax) AS mt, stddev_pop(tax) AS st FROM i)
SELECT {KEY}, round((quantity - mq) / sq, 6) AS quantity, round((discount - md) / sd, 6) AS discount, round((tax - mt) / st, 6) AS tax FROM i, s""")
def standardize(spark, sf_dir):
    i = C.impute(observations(spark, sf_dir), ["quantity"], "median").select(*_KEYS, "quantity", "discount", "tax")
    return rounded(scale(i, fit_scaler(i, ["quantity", "discount", "tax"])), "quantity", "discount", "tax", digits=6)


# ---- naive Bayes -----------------------------------------------------------------

_NB_ROWS = f"""{DAILY}, r AS (SELECT station, d, total, top, n_events, CASE WHEN rain_today = 'Yes' THEN 1 ELSE 0 END AS y FROM daily)"""
_F = ["total", "top", "n_events"]


def _nb_params(src: str, cols, label: str) -> str:
    moments = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in cols)
    spread = ", ".join(f"var_pop({c})" for c in cols)
    return (f"k AS (SELECT {label} AS class, CAST(count(*) AS DOUBLE) AS n, {moments} FROM {src} GROUP BY 1),\n"
            f"e AS (SELECT 1e-9 * greatest({spread}) AS eps, CAST(count(*) AS DOUBLE) AS n FROM {src}),\n"
            "p AS (SELECT k.class, k.n AS n, k.n / e.n AS share, "
            + ", ".join(f"m_{c}, v_{c} + eps AS v_{c}" for c in cols) + " FROM k, e)")


def _nb_score(src: str, cols, keys: str) -> str:
    ll = " + ".join(f"ln(2 * pi() * p.v_{c}) + ({src}.{c} - p.m_{c}) * ({src}.{c} - p.m_{c}) / p.v_{c}" for c in cols)
    return (f"ll AS (SELECT {keys}, max(ln(p.share) - 0.5 * ({ll})) FILTER (p.class = 0) AS l0,\n"
            f"  max(ln(p.share) - 0.5 * ({ll})) FILTER (p.class = 1) AS l1 FROM {src}, p GROUP BY ALL),\n"
            f"pr AS (SELECT {keys}, 1 / (1 + exp(l0 - l1)) AS probability FROM ll)")


def _nb_rows(spark, sf_dir):
    return daily(spark, sf_dir).withColumn("y", yesno_to_int("rain_today"))


@query("nb_fit", f"""WITH {_NB_ROWS}, {_nb_params("r", _F, "y")} SELECT class, CAST(n AS BIGINT) AS n, round(share, 6) AS share,
  round(m_total, 4) AS m_total, round(v_total, 4) AS v_total, round(m_top, 4) AS m_top, round(v_top, 4) AS v_top FROM p""")
def nb_fit(spark, sf_dir):
    p = bayes.fit_bayes(_nb_rows(spark, sf_dir), _F, "y")
    out = p.select("class", "n", "share", F.col("mean")[0].alias("m_total"), F.col("var")[0].alias("v_total"),
                   F.col("mean")[1].alias("m_top"), F.col("var")[1].alias("v_top"))
    return rounded(rounded(out, "m_total", "v_total", "m_top", "v_top"), "share", digits=6)


@query("nb_predict", f"""WITH {_NB_ROWS}, {_nb_params("r", _F, "y")}, {_nb_score("r", _F, "station, d")}
SELECT station, d, round(probability, 6) AS probability, CAST(probability > 0.5 AS INTEGER) AS prediction FROM pr""")
def nb_predict(spark, sf_dir):
    rows = _nb_rows(spark, sf_dir)
    out = bayes.predict_bayes(rows, bayes.fit_bayes(rows, _F, "y"), _F)
    return rounded(out.select("station", "d", "probability", "prediction"), "probability", digits=6)


@query("nb_next_day", f"""WITH {_NB_ROWS}, {_nb_params("r", _F, "y")}, t AS (SELECT * FROM r WHERE d = (SELECT max(d) FROM r)),
{_nb_score("t", _F, "station, d")}
SELECT station, d, strftime(d + INTERVAL 1 DAY, '%Y-%m-%d') AS "NextDate", CASE WHEN probability > 0.5 THEN 'Yes' ELSE 'No' END AS "RainTomorrow_Prediction",
  round(probability, 6) AS "RainTomorrow_Probability" FROM pr""")
def nb_next_day(spark, sf_dir):
    rows = _nb_rows(spark, sf_dir)
    out = bayes.predict_next_day(rows, bayes.fit_bayes(rows, _F, "y"), _F, STATION)
    return rounded(out, "RainTomorrow_Probability", digits=6)


_RISK_SQL = f"""WITH {OBS}, m AS (SELECT median(quantity) AS q, median(price) AS pr FROM obs),
mode_flag AS (SELECT flag FROM obs WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1),
i AS (SELECT {KEY}, coalesce(quantity, q) AS quantity, coalesce(price, pr) AS price, discount, tax,
  CAST(month(d) AS DOUBLE) AS "Month", coalesce(flag, (SELECT flag FROM mode_flag)) AS flag FROM obs, m),
f AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM i),
r AS (SELECT i.*, CASE WHEN price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END AS price_Outlier,
  CASE WHEN flag = 'R' THEN 1 ELSE 0 END AS y FROM i, f),
{_nb_params("r", ["quantity", "price", "discount", "tax", "Month"], "y")},
{_nb_score("r", ["quantity", "price", "discount", "tax", "Month"], KEY)}
SELECT 'run_001' AS run_id, supplier AS city, round(avg(probability), 6) AS climate_risk_index FROM pr GROUP BY 2"""


@query("risk_flow", _RISK_SQL)
def risk_flow(spark, sf_dir):
    """Fill, date, flag outliers, fit and apply naive Bayes, mean probability per entity."""
    rows = risk_features(observations(spark, sf_dir), "d", ("quantity", "price"), ("flag",), "price")
    rows = rows.withColumn("y", (F.col("flag") == "R").cast("int")).withColumn("Month", F.col("Month").cast("double"))
    out = risk_by_bayes(rows, ["quantity", "price", "discount", "tax", "Month"], "y", "supplier")
    return rounded(out, "climate_risk_index", digits=6)


@query("inference_input", f"""WITH {OBS} SELECT {KEY}, quantity, price, CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS status_yes,
  CAST(year(d) AS INTEGER) AS "Year", CAST(isodow(d) - 1 AS INTEGER) AS "DayOfWeek", CASE WHEN flag = 'N' THEN 1 ELSE 0 END AS "flag_N",
  CASE WHEN flag = 'R' THEN 1 ELSE 0 END AS "flag_R" FROM obs WHERE quantity IS NOT NULL AND price IS NOT NULL AND status IS NOT NULL AND flag IS NOT NULL""")
def inference_input(spark, sf_dir):
    rows = observations(spark, sf_dir).withColumn("status_yes", F.when(F.col("status") == "O", "Yes").when(F.col("status") == "F", "No"))
    rows = regress.with_calendar(rows, "d")
    ready = regress.prepare_inference(rows, "flag", ["quantity", "price"], "status_yes", keys=_KEYS)
    hot = C.one_hot(ready, "flag", drop_first=True)
    return hot.select(*_KEYS, "quantity", "price", "status_yes", "Year", "DayOfWeek", "flag_N", "flag_R")


# ---- regression ------------------------------------------------------------------

_OLS = f"""{DAILY}, c AS (SELECT var_pop(top) AS v1, var_pop(n_events) AS v2, covar_pop(top, n_events) AS c12, covar_pop(top, total) AS c1y,
  covar_pop(n_events, total) AS c2y, avg(top) AS m1, avg(n_events) AS m2, avg(total) AS my FROM daily),
b AS (SELECT (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2, m1, m2, my FROM c)"""


@query("ols_coefficients", f"""WITH {_OLS} SELECT 'intercept' AS term, round(my - b1 * m1 - b2 * m2, 6) AS value FROM b
UNION ALL SELECT 'top', round(b1, 6) FROM b UNION ALL SELECT 'n_events', round(b2, 6) FROM b""")
def ols_coefficients(spark, sf_dir):
    model = regress.fit_regressor(daily(spark, sf_dir), ["top", "n_events"], "total")
    return rounded(regress.coefficients(model, spark), "value", digits=6)


@query("ols_metrics", f"""WITH {_OLS}, e AS (SELECT total AS y, my + b1 * (top - m1) + b2 * (n_events - m2) AS p FROM daily, b)
SELECT count(*) AS n, round(avg((y - p) * (y - p)), 4) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
  round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM e""")
def ols_metrics(spark, sf_dir):
    rows = daily(spark, sf_dir)
    scored = regress.predict(regress.fit_regressor(rows, ["top", "n_events"], "total"), rows)
    return rounded(rounded(regression_metrics(scored, "total", "prediction"), "mse", "rmse", "mae"), "r2", digits=6)


def _split(spark, sf_dir):
    return hash_split(daily(spark, sf_dir), ["station", "d"])


@query("tree_group_means", f"""WITH {DAILY}, p AS (SELECT total AS y, avg(total) OVER (PARTITION BY n_events) AS p FROM daily)
SELECT count(*) AS n, round(avg((y - p) * (y - p)), 4) AS mse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM p""")
def tree_group_means(spark, sf_dir):
    """A tree without a depth limit on one whole-number feature predicts the mean of each of its values."""
    rows = daily(spark, sf_dir)
    out = regression_metrics(regress.predict(regress.fit_regressor(rows, ["n_events"], "total", "tree"), rows), "total", "prediction")
    return rounded(rounded(out, "mse"), "r2", digits=6).select("n", "mse", "r2")


@query("tree_any_depth", f"""WITH {DAILY} SELECT station, d, round(avg(total) OVER (PARTITION BY top, n_events), 4) AS prediction FROM daily""")
def tree_any_depth(spark, sf_dir):
    """A tree without a depth limit predicts, on its own rows, the mean of all rows with the same features."""
    rows = daily(spark, sf_dir)
    model = trees.fit_forest(rows, ["top", "n_events"], "total", _DAY, trees=1)
    return rounded(trees.predict(model, rows).select("station", "d", "prediction"), "prediction")


@query("tree_node_counts", f"""WITH {DAILY}
SELECT CAST(1 AS BIGINT) AS trees, CAST(count(*) AS DOUBLE) AS rows_in_leaves FROM daily""")
def tree_node_counts(spark, sf_dir):
    """The leaves of a tree hold every row once."""
    model = trees.fit_forest(daily(spark, sf_dir), ["top", "n_events"], "total", _DAY, trees=1)
    return model.nodes.agg(F.count_distinct("tree").alias("trees"), F.sum(F.when(F.col("feature") < 0, F.col("n"))).alias("rows_in_leaves"))


@query("tree_regression")
def tree_regression(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = trees.fit_forest(train, ["top", "n_events"], "total", _DAY, trees=1)
    return regression_metrics(trees.predict(model, test), "total", "prediction")


@query("forest_regression")
def forest_regression(spark, sf_dir):
    """100 trees without a depth limit."""
    train, test = _split(spark, sf_dir)
    model = trees.fit_forest(train, ["top", "n_events"], "total", _DAY)
    return regression_metrics(trees.predict(model, test), "total", "prediction")


@query("forest_depth10")
def forest_depth10(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = regress.fit_regressor(train, ["top", "n_events"], "total", "forest", maxDepth=10)
    return regression_metrics(regress.predict(model, test), "total", "prediction")


@query("forest_from_params")
def forest_from_params(spark, sf_dir):
    rows = daily(spark, sf_dir).select("total", "top", "n_events")
    params = {"model_type": "RandomForestRegressor", "n_estimators": 100, "max_depth": 10, "random_state": 42}
    return regression_metrics(regress.predict(regress.fit_from_params(rows, "total", params), rows), "total", "prediction")


@query("linear_svr")
def linear_svr(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    weights = margin.fit_svr(train, ["top", "n_events"], "total")
    return regression_metrics(margin.predict_margin(test, weights, "_hat"), "total", "total_hat")


@query("kernel_svr")
def kernel_svr(spark, sf_dir):
    """The exact dual at C = 100, gamma = 0.1, scored on held-out rows."""
    train, test = _split(spark, sf_dir)
    model = kernel.fit_kernel_svr(train, ["top", "n_events"], "total")
    return regression_metrics(kernel.predict_kernel(model, test), "total", "prediction")


@query("kernel_svr_certificate", f"""WITH {DAILY} SELECT count(*) AS n, true AS gap_within_a_thousandth, true AS sum_of_duals_is_0 FROM daily""")
def kernel_svr_certificate(spark, sf_dir):
    """The duality gap of a fit on all rows proves it to be within a thousandth of the optimum."""
    rows = daily(spark, sf_dir)
    model = kernel.fit_kernel_svr(rows, ["top", "n_events"], "total")
    total = model.vectors.agg(F.abs(F.sum("beta")) < 1e-6).first()[0]
    return kernel.predict_kernel(model, rows).agg(F.count("prediction").alias("n"), F.lit(0 <= model.gap <= 1e-3).alias("gap_within_a_thousandth"),
                                                  F.lit(total).alias("sum_of_duals_is_0"))


@query("kernel_svr_fourier")
def kernel_svr_fourier(spark, sf_dir):
    """The approximation by 64 random Fourier features, for very many rows."""
    train, test = _split(spark, sf_dir)
    return regression_metrics(margin.fit_kernel_svr(train, ["top", "n_events"], "total")(test), "total", "prediction")


@query("label_classifier")
def label_classifier(spark, sf_dir):
    rows = _nb_rows(spark, sf_dir)
    weights, platt = margin.fit_classifier(rows, _F, ["y"])
    return margin.predict_classifier(rows, weights, platt).select("station", "d", "y", "y_probability")


@query("label_forest")
def label_forest(spark, sf_dir):
    """100 trees without a depth limit over measures and the one-hot entity."""
    rows = _nb_rows(spark, sf_dir)
    model = trees.fit_forest(rows, _F, "y", _DAY, entity="station", draw="sqrt")
    return trees.predict_label(model, rows, "PredictedRainTomorrow").select("station", "d", "PredictedRainTomorrow")


@query("label_tree", f"""WITH {_NB_ROWS}, m AS (SELECT station, d, avg(y) OVER (PARTITION BY total, top, n_events, station) AS p FROM r)
SELECT station, d, round(p, 6) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction FROM m""")
def label_tree(spark, sf_dir):
    """One unpruned tree over measures and entity gives back the share of each distinct feature row."""
    rows = _nb_rows(spark, sf_dir)
    model = trees.fit_forest(rows, _F, "y", _DAY, trees=1, entity="station")
    return rounded(trees.predict_label(model, rows, probability="probability").select("station", "d", "probability", "prediction"), "probability", digits=6)


# ---- clusters, components, isolation ----------------------------------------------

@query("kmeans_assign", """WITH x AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS cluster, i, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY 1, 2),
d AS (SELECT vec_id, cluster, sum((CAST(v AS DOUBLE) - m) * (CAST(v AS DOUBLE) - m)) AS d2 FROM x JOIN c USING (i) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS rn FROM d)
SELECT vec_id, cluster, round(d2, 6) AS distance2 FROM r WHERE rn = 1""")
def kmeans_assign(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    centres = (e.select("label", F.posexplode("embedding").alias("i", "v"))
               .groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
               .groupBy(F.col("label").alias("cluster"))
               .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre")))
    return rounded(clusters.assign_vectors(e.select("vec_id", "embedding"), centres, "embedding").drop("embedding"), "distance2", digits=6)


@query("inertia", """WITH x AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS cluster, i, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY 1, 2),
d AS (SELECT vec_id, cluster, sum((CAST(v AS DOUBLE) - m) * (CAST(v AS DOUBLE) - m)) AS d2 FROM x JOIN c USING (i) GROUP BY 1, 2)
SELECT round(sum(m), 4) AS inertia FROM (SELECT vec_id, min(d2) AS m FROM d GROUP BY 1)""")
def inertia(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    wide, names = clusters.embedding_columns(e.select("vec_id", "label", "embedding"), "embedding")
    centres = wide.groupBy(F.col("label").alias("cluster")).agg(*[F.avg(c).alias(c) for c in names])
    return rounded(clusters.inertia(clusters.assign(wide, centres, names)), "inertia")


def _scaled_days(spark, sf_dir, cols=("total", "top", "n_events")):
    rows = daily(spark, sf_dir).select("station", "d", *cols)
    return scale(rows, fit_scaler(rows, list(cols)))


@query("kmeans_fit")
def kmeans_fit(spark, sf_dir):
    rows = _scaled_days(spark, sf_dir)
    centres, _ = clusters.fit_kmeans(rows, _F, 4)
    return clusters.assign(rows, centres, _F).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("distance2").alias("inertia"))


@query("kmeans_two_means", f"""WITH {DAILY}, s AS (SELECT station, d, total, row_number() OVER (ORDER BY total) AS i, count(*) OVER () AS n,
  sum(total) OVER (ORDER BY total ROWS UNBOUNDED PRECEDING) AS below, sum(total * total) OVER (ORDER BY total ROWS UNBOUNDED PRECEDING) AS below2,
  sum(total) OVER () AS s1, sum(total * total) OVER () AS s2 FROM daily),
c AS (SELECT *, below2 - below * below / i + (s2 - below2) - (s1 - below) * (s1 - below) / (n - i) AS cost FROM s WHERE i < n)
SELECT round(min(cost) / max(s2 - s1 * s1 / n), 3) AS unexplained FROM c""")
def kmeans_two_means(spark, sf_dir):
    """Two clusters of one measure against the best cut of its sorted values."""
    rows = daily(spark, sf_dir).select("total")
    runs = clusters.fit_kmeans_runs(rows, ["total"], 2, tol=0.0)
    return rows.agg(F.round(F.lit(float(runs.inertia[runs.best])) / (F.var_pop("total") * F.count("total")), 3).alias("unexplained"))


@query("silhouette_euclidean", """WITH v AS (SELECT vec_id AS i, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.i, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n FROM v a, v b GROUP BY ALL),
p AS (SELECT i, max(s / (n - 1)) FILTER (own = other AND n > 1) AS a, min(s / n) FILTER (own <> other) AS b FROM d GROUP BY 1)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM p""")
def silhouette_euclidean(spark, sf_dir):
    e, names = clusters.embedding_columns(table(spark, sf_dir, "embeddings"), "embedding")
    return spark.createDataFrame([(round(clusters.silhouette(e, "label", names, "euclidean"), 6),)], "silhouette double")


@query("silhouette", """WITH x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS cluster, i, avg(v) AS m FROM x GROUP BY 1, 2),
d AS (SELECT vec_id, label, cluster, sum((v - m) * (v - m)) AS d2 FROM x JOIN c USING (i) GROUP BY 1, 2, 3),
w AS (SELECT cluster, avg(d2) AS spread, count(*) AS n FROM d WHERE label = cluster GROUP BY 1),
p AS (SELECT vec_id, max((d2 + spread) * n / (n - 1)) FILTER (label = cluster) AS a, min(d2 + spread) FILTER (label <> cluster) AS b
  FROM d JOIN w USING (cluster) GROUP BY 1)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM p""")
def silhouette(spark, sf_dir):
    e, names = clusters.embedding_columns(table(spark, sf_dir, "embeddings"), "embedding")
    return spark.createDataFrame([(round(clusters.silhouette(e, "label", names), 6),)], "silhouette double")


_DB = "s AS (SELECT event_id, value AS a, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS b FROM events)"


def _event_points(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("value").alias("a"), F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("b"))


@query("dbscan_neighbors", f"""WITH {_DB}, n AS (SELECT x.event_id, count(*) AS c FROM s x JOIN s y
  ON y.a BETWEEN x.a - 2.5 AND x.a + 2.5 AND y.b BETWEEN x.b - 2.5 AND x.b + 2.5
  AND (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) <= 2.5 * 2.5 GROUP BY 1)
SELECT event_id, c >= 5 AS is_core FROM n""")
def dbscan_neighbors(spark, sf_dir):
    rows = _event_points(spark, sf_dir)
    pts, near = density.neighbourhoods(rows, "event_id", ["a", "b"], 2.5, 5)
    core = density.neighbour_counts(pts, near, 5).join(pts.select("pid", "x"), "pid")
    keyed = rows.select("event_id", F.array("a", "b").alias("x"))
    return keyed.join(core, "x").select("event_id", "is_core")


@query("dbscan_noise", f"""WITH {_DB}, n AS (SELECT x.event_id AS e, y.event_id AS o FROM s x JOIN s y
  ON y.a BETWEEN x.a - 2.5 AND x.a + 2.5 AND y.b BETWEEN x.b - 2.5 AND x.b + 2.5
  AND (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) <= 2.5 * 2.5),
c AS (SELECT e FROM n GROUP BY 1 HAVING count(*) >= 5)
SELECT e AS event_id, CAST(count(*) FILTER (o IN (SELECT e FROM c)) = 0 AS INTEGER) AS is_anomaly FROM n GROUP BY 1""")
def dbscan_noise(spark, sf_dir):
    return density.dbscan(_event_points(spark, sf_dir), "event_id", ["a", "b"], 2.5, 5).select("event_id", "is_anomaly")


@query("dbscan_line", """WITH c AS (SELECT event_id, value, count(*) OVER (ORDER BY value RANGE BETWEEN 0.205 PRECEDING AND 0.205 FOLLOWING) AS n FROM events),
k AS (SELECT event_id, value, CASE WHEN value - lag(value) OVER (ORDER BY value, event_id) <= 0.205 THEN 0 ELSE 1 END AS cut FROM c WHERE n >= 5),
g AS (SELECT event_id, value, sum(cut) OVER (ORDER BY value, event_id) AS grp FROM k),
m AS (SELECT grp, row_number() OVER (ORDER BY min(event_id)) - 1 AS number, min(value) AS lo, max(value) AS hi FROM g GROUP BY 1)
SELECT c.event_id, CAST(coalesce(min(m.number), -1) AS INTEGER) AS dbscan_cluster FROM c
LEFT JOIN (g JOIN m USING (grp)) ON abs(g.value - c.value) <= 0.205 AND (c.n < 5 OR g.event_id = c.event_id) GROUP BY 1""")
def dbscan_line(spark, sf_dir):
    out = density.dbscan(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", ["value"], 0.205, 5)
    return out.select("event_id", "dbscan_cluster")


@query("dbscan_vectors", """WITH RECURSIVE v AS (SELECT vec_id AS i, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
n AS (SELECT a.i AS i, b.i AS j FROM v a, v b WHERE list_distance(a.x, b.x) <= 1.17),
core AS (SELECT i FROM n GROUP BY i HAVING count(*) >= 5),
e AS (SELECT i, j FROM n WHERE i IN (FROM core) AND j IN (FROM core)),
r(i, j) AS (SELECT i, j FROM e UNION SELECT r.i, e.j FROM r JOIN e ON r.j = e.i),
c AS (SELECT i, min(j) AS root FROM r GROUP BY i),
k AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS number FROM (SELECT DISTINCT root FROM c)),
m AS (SELECT n.i, min(number) AS number FROM n JOIN c ON c.i = n.j JOIN k USING (root) GROUP BY n.i)
SELECT v.i AS vec_id, CAST(coalesce(m.number, -1) AS INTEGER) AS dbscan_cluster, CAST(m.number IS NULL AS INTEGER) AS is_anomaly
FROM v LEFT JOIN m ON m.i = v.i""")
def dbscan_vectors(spark, sf_dir):
    """Density clusters over all dimensions of the vectors."""
    e, names = clusters.embedding_columns(table(spark, sf_dir, "embeddings"), "embedding")
    return density.dbscan(e, "vec_id", names, 1.17, 5).select("vec_id", "dbscan_cluster", "is_anomaly")


@query("pca_two_measures", f"""WITH {DAILY}, r AS (SELECT abs(corr(top, n_events)) AS r FROM daily)
SELECT 'PC1' AS component, round((1 + r) / 2, 6) AS explained_ratio, round((1 + r) / 2, 6) AS cumulative_ratio FROM r
UNION ALL SELECT 'PC2', round((1 - r) / 2, 6), CAST(1 AS DOUBLE) FROM r""")
def pca_two_measures(spark, sf_dir):
    rows = _scaled_days(spark, sf_dir, ("top", "n_events"))
    return rounded(clusters.fit_pca(rows, ["top", "n_events"], 2)[1], "explained_ratio", "cumulative_ratio", digits=6)


@query("pca_scores")
def pca_scores(spark, sf_dir):
    rows, names = clusters.embedding_columns(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    return clusters.project(rows, clusters.fit_pca(rows, names, 3)[0]).select("vec_id", "PC1", "PC2", "PC3")


@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    rows = _scaled_days(spark, sf_dir)
    forest = isolation.fit_iforest(rows, ["station", "d"], _F)
    return isolation.detect(rows, forest, _F).select("station", "d", "anomaly_score", "is_anomaly")


