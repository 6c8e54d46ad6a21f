"""Jobs around the models: stored results, metric rows, run names, extracts, published forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from obsledger.functions.scalars import default_run_id
from obsledger.models import bayes, density
from obsledger.operators import catalogue, evaluate, insight, publish
from obsledger.operators.reshape import nest_forecast
from obsledger.plans import regression
from obsledger.queries import query
from obsledger.queries.forecasts import STATION
from obsledger.queries.frames import DAILY, METRICS, daily, metric_rows, rounded, table
from obsledger.queries.learned import _F, _nb_params, _nb_rows, _nb_score, _NB_ROWS
from obsledger.session import checkpoint_dir
from obsledger.sources import commits, files


@query("stored_once", """SELECT o_orderstatus AS commit_key, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
FROM orders GROUP BY 1""")
def stored_once(spark, sf_dir):
    """Every status is stored twice under its key; what is read holds it once, and nothing of an attempt never published."""
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4()}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for _ in range(2):
        for status in ("F", "O", "P"):
            commits.append_once(orders.where(F.col("o_orderstatus") == status), path, status)
    commits.stage(orders, path)
    stored = commits.read_committed(spark, path, orders.schema)
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return stored.groupBy("commit_key").agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents"))


@query("density_measures", """WITH c AS (SELECT event_id, value, count(*) OVER (ORDER BY value RANGE BETWEEN 0.205 PRECEDING AND 0.205 FOLLOWING) AS n FROM events),
k AS (SELECT value, CASE WHEN value - lag(value) OVER (ORDER BY value, event_id) <= 0.205 THEN 0 ELSE 1 END AS cut FROM c WHERE n >= 5),
e AS (SELECT c.event_id, min(k.value) AS core FROM c LEFT JOIN k ON abs(k.value - c.value) <= 0.205 GROUP BY 1),
m AS (SELECT (SELECT sum(cut) FROM k) AS n_clusters, count(*) FILTER (core IS NULL) AS noise, count(*) AS n FROM e)
SELECT 'n_clusters' AS metric, CAST(n_clusters AS DOUBLE) AS value FROM m UNION ALL SELECT 'n_noise_points', CAST(noise AS DOUBLE) FROM m
UNION ALL SELECT 'noise_percentage', round(100.0 * noise / n, 4) FROM m""")
def density_measures(spark, sf_dir):
    """What the density job keeps as metric rows."""
    labelled = density.dbscan(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", ["value"], 0.205, 5)
    found = [(name, round(float(value), 4)) for name, value in density.measures(labelled).items()]
    return spark.createDataFrame(found, "metric string, value double")


_METERED = ["mse", "rmse", "mae", "r2", "training_time_seconds", "prediction_time_seconds", "rows_scored", "model_size"]


@query("metered_regression", f"""WITH {DAILY}, m AS (SELECT unnest(['LinearRegression', 'DecisionTreeRegressor', 'SVM']) AS model_name),
k AS (SELECT unnest({_METERED}) AS metric)
SELECT 'r1' AS run_id, model_name, metric, (SELECT count(*) FROM daily) > 0 AS positive FROM m, k""")
def metered_regression(spark, sf_dir):
    """Every model of the regression job with its scores, seconds, rows scored and size."""
    found = regression.run_regressions(daily(spark, sf_dir), ["top", "n_events"], "total", ["station", "d"], "r1", kinds=("ols", "tree", "svr"))
    return found.select("run_id", "model_name", "metric", (F.col("value") > 0).alias("positive"))


@query("run_names", """SELECT CASE o_orderstatus WHEN 'F' THEN 'run_f' ELSE 'svr_' END AS name, count(*) AS n FROM orders GROUP BY 1""")
def run_names(spark, sf_dir):
    """Run ids that are missing or empty are made of the model's name and the time, which is cut off here."""
    given = F.when(F.col("o_orderstatus") == "F", "run_f").when(F.col("o_orderstatus") == "O", "")
    named = table(spark, sf_dir, "orders").select(F.regexp_replace(default_run_id(given, "svr"), "[0-9]{14}$", "").alias("name"))
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("nb_scores_of_given_rows", f"""WITH {_NB_ROWS}, {_nb_params("r", _F, "y")},
g AS (SELECT station, d, total, CASE WHEN n_events > 1 THEN top END AS top, n_events FROM r),
t AS (SELECT station, d, total, coalesce(top, avg(top) OVER ()) AS top, n_events FROM g), {_nb_score("t", _F, "station, d")}
SELECT station, d, CASE WHEN probability > 0.5 THEN 'Yes' ELSE 'No' END AS "RainTomorrow_Prediction", round(probability, 6) AS "RainTomorrow_Probability" FROM pr""")
def nb_scores_of_given_rows(spark, sf_dir):
    """Rows from elsewhere, such as synthetic ones, with gaps filled by their mean, scored with fitted parameters."""
    rows = _nb_rows(spark, sf_dir)
    given = rows.select("station", "d", "total", F.when(F.col("n_events") > 1, F.col("top")).alias("top"), "n_events")
    out = bayes.predict_rows(given, bayes.fit_bayes(rows, _F, "y"), _F)
    return rounded(out.select("station", "d", "RainTomorrow_Prediction", "RainTomorrow_Probability"), "RainTomorrow_Probability", digits=6)


@query("loading_insights", """WITH l AS (SELECT 'PC' || CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS component,
  o_orderpriority AS feature, avg(o_totalprice) / 100000 - 1.5 AS loading, count(*) AS n FROM orders GROUP BY 1, 2),
v AS (SELECT component, round(sum(n) / (SELECT count(*) FROM orders), 6) AS explained_ratio FROM l GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY abs(loading) DESC, feature) AS place FROM l WHERE component IN ('PC1', 'PC2'))
SELECT component, feature, round(loading, 4) AS loading, explained_ratio, CASE WHEN loading > 0 THEN 'positivo' ELSE 'negativo' END AS sign
FROM r JOIN v USING (component) WHERE place <= 3""")
def loading_insights(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "component", F.concat(F.lit("PC"), F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "2").otherwise("3")))
    loadings = orders.groupBy("component", F.col("o_orderpriority").alias("feature")).agg(
        (F.avg("o_totalprice") / 100000 - 1.5).alias("loading"), F.count(F.lit(1)).alias("n"))
    total = orders.agg(F.count(F.lit(1)).alias("n")).scalar()
    variance = loadings.groupBy("component").agg(F.round(F.sum("n") / total, 6).alias("explained_ratio"))
    out = insight.loading_insights(loadings.drop("n"), variance)
    return rounded(out.select("component", "feature", "loading", "explained_ratio", "sign"), "loading")


@query("metric_documents", """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN '{"a": 1}' END, o_orderpriority) AS importance FROM orders""")
def metric_documents(spark, sf_dir):
    """The first present of several document columns under one name."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("coef"), F.when(F.col("o_orderstatus") == "F", '{"a": 1}').alias("coefficients"))
    return catalogue.pick_document(rows, catalogue.IMPORTANCE_KEYS, "importance")


@query("forecast_api_form", f"""WITH {DAILY} SELECT 'success' AS status, '2025-01-01 00:00:00' AS forecast_generated_at, CAST(3 AS INTEGER) AS forecast_period_days,
  'SVM' AS model_type, '1.0' AS version, station AS location, CAST(count(*) AS INTEGER) AS n_days FROM daily GROUP BY station""")
def forecast_api_form(spark, sf_dir):
    nested = nest_forecast(daily(spark, sf_dir), "station", "d", {"rainfall_mm": "total"}, "rain_today")
    out = publish.api_form(nested, 3, "2025-01-01 00:00:00")
    return out.withColumn("n_days", F.size("days")).drop("days")


@query("dashboard_extracts", f"""WITH {METRICS} SELECT 'regression' AS extract, count(*) AS n, round(sum(value) / 1e6, 2) AS total FROM reg
UNION ALL SELECT 'classification', count(*), round(sum(value) / 1e6, 2) FROM cls""")
def dashboard_extracts(spark, sf_dir):
    """Metric rows written as CSV extracts and read back."""
    regressions, classes = metric_rows(spark, sf_dir)
    paths = files.export_extracts({"regression": regressions, "classification": classes}, f"{checkpoint_dir(spark)}/extracts-{uuid.uuid4()}")
    out = None
    for path in paths:
        rows = files.read_table(spark, path, "csv", regressions.schema)
        one = rows.agg(F.lit(path.rsplit("/", 1)[1]).alias("extract"), F.count(F.lit(1)).alias("n"), F.round(F.sum("value") / 1e6, 2).alias("total"))
        out = one if out is None else out.unionByName(one)
    return out


@query("next_day_or_error", f"""WITH {_NB_ROWS}, {_nb_params("r", _F, "y")}, t AS (SELECT * FROM r WHERE d = (SELECT max(d) FROM r)), {_nb_score("t", _F, "station, d")}
SELECT station, d, strftime(d + INTERVAL 1 DAY, '%Y-%m-%d') AS "NextDate", CASE WHEN probability > 0.5 THEN 'Yes' ELSE 'No' END AS "RainTomorrow_Prediction",
  round(probability, 6) AS "RainTomorrow_Probability", CAST(NULL AS VARCHAR) AS error FROM pr
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'No hay datos para la fecha 1900-01-01' WHERE NOT EXISTS (SELECT 1 FROM daily WHERE d = DATE '1900-01-01')""")
def next_day_or_error(spark, sf_dir):
    """The latest date's predictions, and what a date without rows gives."""
    rows = _nb_rows(spark, sf_dir)
    params = bayes.fit_bayes(rows, _F, "y")
    latest, none = (bayes.next_day_or_error(rows, params, _F, STATION, date) for date in (None, "1900-01-01"))
    return rounded(latest.unionByName(none), "RainTomorrow_Probability", digits=6)


@query("forecast_label_agreement", f"""WITH {DAILY}, s AS (SELECT n_events, rain_today = 'Yes' AS y, top > 50 AS p FROM daily),
k AS (SELECT n_events, count(*) AS n, count(*) FILTER (y = p) AS hit, count(*) FILTER (y AND p) AS tp, count(*) FILTER (p AND NOT y) AS fp, count(*) FILTER (y AND NOT p) AS fn FROM s GROUP BY 1)
SELECT n_events, n, round(hit / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM k""")
def forecast_label_agreement(spark, sf_dir):
    """A label forecast against what happened, per group of days."""
    rows = daily(spark, sf_dir)
    forecast = rows.select("station", "d", "n_events", F.when(F.col("top") > 50, "Yes").otherwise("No").alias("rain_today"))
    out = evaluate.label_agreement(forecast, rows, ["station", "d"], "rain_today", "n_events")
    return rounded(out, "accuracy", "precision", "recall", "f1", digits=6)
