"""Metric catalogue queries over metric rows computed from lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import scalars as S
from obsledger.operators import catalogue as K
from obsledger.operators import reshape as R
from obsledger.queries import query
from obsledger.queries.frames import METRICS, metric_rows, rounded, table


@query("metrics_long", f"WITH {METRICS} SELECT run_id, model_name, metric, round(value, 4) AS value FROM reg")
def metrics_long(spark, sf_dir):
    return rounded(metric_rows(spark, sf_dir)[0], "value")


@query("metrics_wide", f"WITH {METRICS} SELECT run_id, model_name, round(accuracy, 6) AS accuracy, round(\"precision\", 6) AS \"precision\", "
       "round(recall, 6) AS recall, round(f1, 6) AS f1 FROM clsw")
def metrics_wide(spark, sf_dir):
    out = R.metrics_wide(metric_rows(spark, sf_dir)[1], ["accuracy", "precision", "recall", "f1"], ["run_id", "model_name"])
    return rounded(out, "accuracy", "precision", "recall", "f1", digits=6)


@query("combined_metrics", f"""WITH {METRICS}
SELECT run_id, 'price_guess' AS model_name, metric, round(value, 4) AS value, 'regression' AS type FROM reg WHERE model_name = 'model1'
UNION ALL SELECT run_id, 'price_second', metric, round(value, 4), 'regression' FROM reg WHERE model_name = 'model2'""")
def combined_metrics(spark, sf_dir):
    reg = metric_rows(spark, sf_dir)[0]
    named = {"price_guess": reg.where("model_name = 'model1'"), "price_second": reg.where("model_name = 'model2'")}
    return rounded(K.combine_metrics(named, "regression"), "value")


@query("distinct_runs", f"WITH {METRICS} SELECT run_id FROM reg UNION SELECT run_id FROM cls ORDER BY 1")
def distinct_runs(spark, sf_dir):
    return K.runs(*metric_rows(spark, sf_dir))


@query("metrics_by_run_model", f"""WITH {METRICS} SELECT run_id, model_name, metric, round(value, 6) AS value FROM cls
WHERE run_id = 'run_1997' AND model_name = 'model3'""")
def metrics_by_run_model(spark, sf_dir):
    return rounded(K.metrics(metric_rows(spark, sf_dir)[1], "run_1997", "model3"), "value", digits=6)


@query("model_metrics", f"""WITH {METRICS} SELECT run_id, model_name, metric, round(value, 4) AS value, 'regression' AS type FROM reg WHERE model_name = 'model2'
UNION ALL SELECT run_id, model_name, metric, round(value, 4), 'classification' FROM cls WHERE model_name = 'model2'""")
def model_metrics(spark, sf_dir):
    reg, cls = metric_rows(spark, sf_dir)
    return rounded(K.model_metrics(reg, cls, "model2"), "value")


@query("model_metrics_of_kind", f"""WITH {METRICS} SELECT run_id, model_name, metric, round(value, 4) AS value, 'classification' AS type
FROM cls WHERE model_name = 'model5'""")
def model_metrics_of_kind(spark, sf_dir):
    reg, cls = metric_rows(spark, sf_dir)
    return rounded(K.model_metrics(reg, cls, "model5", "Classification"), "value")


_ALIAS = """CASE model_name WHEN 'model1' THEN metric WHEN 'model2' THEN upper(metric) WHEN 'model3' THEN metric || '_score'
  WHEN 'model4' THEN 'model4_' || metric WHEN 'model5' THEN metric ELSE 'unknown_' || metric END"""


@query("canonical_metrics", f"""WITH {METRICS} SELECT run_id, model_name, metric, round(value, 4) AS value FROM reg
WHERE model_name IN ('model1', 'model2', 'model3', 'model4', 'model5')""")
def canonical_metrics(spark, sf_dir):
    reg = metric_rows(spark, sf_dir)[0]
    named = reg.withColumn("metric", F.expr(_ALIAS))
    # model5 also reports every metric under a second name that must lose
    twice = reg.where("model_name = 'model5'").withColumn("metric", F.concat("metric", F.lit("_score"))).withColumn(
        "value", F.col("value") * 2)
    return rounded(K.canonical_metrics(named.unionByName(twice), K.REGRESSION_METRICS), "value")


_MEANS = """means AS (SELECT 'regression' AS type, model_name, metric, avg(value) AS value FROM reg GROUP BY 2, 3
  UNION ALL SELECT 'classification', model_name, metric, avg(value) FROM cls GROUP BY 2, 3)"""


def _means(spark, sf_dir):
    """Mean of every metric over the runs, as one metric row per model and type."""
    reg, cls = metric_rows(spark, sf_dir)
    rows = reg.withColumn("type", F.lit("regression")).unionByName(cls.withColumn("type", F.lit("classification")))
    return rows.groupBy("type", "model_name", "metric").agg(F.avg("value").alias("value"))


@query("performance_summary", f"""WITH {METRICS}, {_MEANS}, s AS (SELECT type, model_name, coalesce(max(CASE
    WHEN type = 'regression' AND metric = 'r2' THEN value WHEN type = 'classification' AND metric = 'f1' THEN value END), 0) AS score
  FROM means GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY score DESC, model_name) AS rn, count(*) OVER (PARTITION BY type) AS n FROM s)
SELECT type, n AS n_models, model_name AS best_model, round(score, 6) AS best_score FROM o WHERE rn = 1""")
def performance_summary(spark, sf_dir):
    return rounded(K.performance_summary(_means(spark, sf_dir)), "best_score", digits=6)


@query("r2_grade", f"""WITH {METRICS}, {_MEANS}, w AS (SELECT model_name, max(value) FILTER (metric = 'r2') AS r2,
  max(value) FILTER (metric = 'mse') AS mse FROM means WHERE type = 'regression' GROUP BY 1)
SELECT model_name, round(r2, 6) AS r2, round(mse, 2) AS mse, CAST(row_number() OVER (ORDER BY r2 DESC, model_name) AS INTEGER) AS "rank",
  round(r2 * 100, 4) AS explained_pct, CASE WHEN r2 >= 0.8 THEN 'excelente' WHEN r2 >= 0.6 THEN 'bueno'
  WHEN r2 >= 0.4 THEN 'moderado' WHEN r2 >= 0.2 THEN 'débil' ELSE 'muy limitado' END AS grade FROM w WHERE r2 IS NOT NULL""")
def r2_grade(spark, sf_dir):
    out = K.rank_models(_means(spark, sf_dir).where("type = 'regression'"))
    return rounded(rounded(rounded(out, "explained_pct"), "r2", digits=6), "mse", digits=2)


@query("grade_all_scores", f"""WITH {METRICS} SELECT run_id, model_name,
  CASE WHEN accuracy >= 0.8 THEN 'excelente' WHEN accuracy >= 0.6 THEN 'bueno' WHEN accuracy >= 0.4 THEN 'moderado'
    WHEN accuracy >= 0.2 THEN 'débil' ELSE 'muy limitado' END AS as_r2,
  CASE WHEN accuracy > 0.9 THEN 'excelente' WHEN accuracy > 0.8 THEN 'buena' WHEN accuracy > 0.7 THEN 'aceptable'
    ELSE 'limitada' END AS as_accuracy,
  CASE WHEN abs("precision" - recall) <= 0.1 THEN 'balanced' WHEN "precision" > recall THEN 'conservative' ELSE 'sensitive' END AS balance
FROM clsw""")
def grade_all_scores(spark, sf_dir):
    wide = R.metrics_wide(metric_rows(spark, sf_dir)[1], ["accuracy", "precision", "recall"], ["run_id", "model_name"])
    return wide.select("run_id", "model_name", S.grade_r2("accuracy").alias("as_r2"), S.grade_accuracy("accuracy").alias("as_accuracy"),
                       S.precision_recall_balance("precision", "recall").alias("balance"))


@query("best_classifier", f"""WITH {METRICS}, {_MEANS}, w AS (SELECT model_name, max(value) FILTER (metric = 'accuracy') AS accuracy,
  max(value) FILTER (metric = 'precision') AS "precision", max(value) FILTER (metric = 'recall') AS recall,
  max(value) FILTER (metric = 'f1') AS f1 FROM means WHERE type = 'classification' GROUP BY 1)
SELECT model_name, round(coalesce(f1, accuracy, 0), 6) AS score, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision",
  round(recall, 6) AS recall, round(f1, 6) AS f1, CASE WHEN accuracy > 0.9 THEN 'excelente' WHEN accuracy > 0.8 THEN 'buena'
  WHEN accuracy > 0.7 THEN 'aceptable' ELSE 'limitada' END AS grade, CASE WHEN abs("precision" - recall) <= 0.1 THEN 'balanced'
  WHEN "precision" > recall THEN 'conservative' ELSE 'sensitive' END AS balance
FROM w ORDER BY coalesce(f1, accuracy, 0) DESC, model_name LIMIT 1""")
def best_classifier(spark, sf_dir):
    out = K.best_classifier(_means(spark, sf_dir).where("type = 'classification'"))
    return rounded(out, "score", "accuracy", "precision", "recall", "f1", digits=6)


@query("comparison_series", f"""WITH {METRICS}, {_MEANS} SELECT model_name AS model, round(max(value) FILTER (metric = 'r2'), 6) AS r2,
  round(max(value) FILTER (metric = 'mse'), 2) AS mse FROM means WHERE type = 'regression' GROUP BY 1""")
def comparison_series(spark, sf_dir):
    out = K.comparison_series(_means(spark, sf_dir).where("type = 'regression'"))
    return rounded(rounded(out, "r2", digits=6), "mse", digits=2)


@query("dashboard_series", f"""WITH {METRICS} SELECT run_id, model_name, round(avg(value), 6) AS value FROM cls WHERE metric = 'f1' GROUP BY 1, 2""")
def dashboard_series(spark, sf_dir):
    return rounded(K.series(metric_rows(spark, sf_dir)[1], "f1"), "value", digits=6)


@query("dashboard_by_model", f"WITH {METRICS} SELECT model_name, round(avg(value), 6) AS value FROM reg WHERE metric = 'r2' GROUP BY 1")
def dashboard_by_model(spark, sf_dir):
    return rounded(K.series(metric_rows(spark, sf_dir)[0], "r2", ["model_name"]), "value", digits=6)


@query("dashboard_scaled", f"""WITH {METRICS}, m AS (SELECT metric, model_name, avg(value) AS value FROM cls GROUP BY 1, 2),
s AS (SELECT *, min(value) OVER (PARTITION BY metric) AS lo, max(value) OVER (PARTITION BY metric) AS hi FROM m)
SELECT metric, model_name, round(value, 6) AS value, round(coalesce((value - lo) / nullif(hi - lo, 0), 0), 6) AS scaled FROM s""")
def dashboard_scaled(spark, sf_dir):
    return rounded(K.scaled_series(metric_rows(spark, sf_dir)[1]), "value", "scaled", digits=6)


@query("confusion_from_scores", f"""WITH {METRICS}, p AS (SELECT run_id, model_name, n, tp + fn AS positives,
  coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0) AS re FROM clsc)
SELECT run_id, model_name, round(re * positives) AS tp, coalesce(round(round(re * positives) / nullif(pr, 0)) - round(re * positives), 0) AS fp,
  positives - round(re * positives) AS fn,
  n - round(re * positives) - coalesce(round(round(re * positives) / nullif(pr, 0)) - round(re * positives), 0) - (positives - round(re * positives)) AS tn
FROM p""")
def confusion_from_scores(spark, sf_dir):
    from obsledger.operators.evaluate import classification_metrics
    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("run_"), F.year("l_shipdate").cast("string")).alias("run_id"),
        F.concat(F.lit("model"), F.col("l_linenumber").cast("string")).alias("model_name"),
        (F.col("l_returnflag") == "R").cast("int").alias("yc"),
        ((F.col("l_discount") * 100 + F.col("l_linenumber")) > 10).cast("int").alias("pc"))
    by = ["run_id", "model_name"]
    positives = li.groupBy(*by).agg(F.sum("yc").cast("double").alias("positives"))
    scores = classification_metrics(li, "yc", "pc", by).withColumn("n", F.col("n").cast("double")).join(positives, by)
    return K.confusion_from_scores(scores).select(*by, "tp", "fp", "fn", "tn")


@query("numeric_metrics", f"""WITH {METRICS} SELECT run_id, model_name, metric, CASE WHEN metric = 'mae' THEN 0.0 ELSE value END AS value FROM (
  SELECT run_id, model_name, metric, round(value, 2) AS value FROM reg)""")
def numeric_metrics(spark, sf_dir):
    reg = rounded(metric_rows(spark, sf_dir)[0], "value", digits=2)
    text = F.when(F.col("metric") == "mae", "nan").when(F.col("metric") == "mse", F.concat(F.lit(" "), F.col("value").cast("string")))
    return K.numeric_metrics(reg.withColumn("value", text.otherwise(F.col("value").cast("string"))))


@query("forecast_metric_defaults", f"""WITH {METRICS} SELECT run_id, model_name, round(mae, 4) AS temperature_mae, CAST(0 AS DOUBLE) AS temperature_rmse,
  'ForecastSVM' AS model_type, CASE WHEN mae > 30000 THEN 'high' ELSE 'not_available' END AS status, 3 AS forecast_horizon_days FROM regw""")
def forecast_metric_defaults(spark, sf_dir):
    from obsledger.operators.publish import FORECAST_METRIC_DEFAULTS as D
    wide = R.metrics_wide(metric_rows(spark, sf_dir)[0], ["mae"], ["run_id", "model_name"])
    have = wide.select("run_id", "model_name", F.round("mae", 4).alias("temperature_mae"), F.when(F.col("mae") > 30000, "high").alias("status"))
    keys = ("temperature_mae", "temperature_rmse", "model_type", "status", "forecast_horizon_days")
    return K.metric_defaults(have, {k: D[k] for k in keys})


@query("sql_bound_param", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000")
def sql_bound_param(spark, sf_dir):
    from obsledger.sources.tables import query as read
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_bound")
    return read(spark, "SELECT o_orderkey, o_totalprice FROM orders_bound WHERE o_orderstatus = :s AND o_totalprice > :p", s="F", p=400000)
