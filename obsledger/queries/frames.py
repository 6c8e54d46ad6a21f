"""Observation frames over the test tables, and the same frames as SQL text.

lineitem plays the observation table (entity: supplier, date: ship date) with
missing values set by rule; events summed per user and day play the daily
station table; orders, customers and labels play the remaining roles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MEASURES = ["quantity", "price", "discount", "tax"]
ROW_KEY = ["orderkey", "linenumber", "partkey", "supplier", "d"]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as observations; quantity, price, flag and status go missing by rule."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("supplier"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.when(F.col("l_linenumber") < 7, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_quantity") < 50, F.col("l_linestatus")).alias("status"),
    )


OBS = """obs AS (
  SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, l_suppkey AS supplier,
         CAST(l_shipdate AS DATE) AS d,
         CASE WHEN l_tax > 0 THEN l_quantity END AS quantity,
         CASE WHEN l_discount > 0 THEN l_extendedprice END AS price,
         l_discount AS discount, l_tax AS tax,
         CASE WHEN l_linenumber < 7 THEN l_returnflag END AS flag,
         CASE WHEN l_quantity < 50 THEN l_linestatus END AS status
  FROM lineitem)"""

DAY_MEASURES = ["total", "top", "n_events"]


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events per user and day: total and largest value, event count, Yes/No for a purchase."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("user_id").alias("station"), F.col("ts").cast("date").alias("d")).agg(
        F.round(F.sum("value"), 2).alias("total"), F.max("value").alias("top"),
        F.count(F.lit(1)).cast("double").alias("n_events"),
        F.when(F.max((F.col("event_type") == "purchase").cast("int")) == 1, "Yes").otherwise("No").alias("rain_today"),
    )


DAILY = """daily AS (
  SELECT user_id AS station, CAST(ts AS DATE) AS d, round(sum(value), 2) AS total, max(value) AS top,
         CAST(count(*) AS DOUBLE) AS n_events,
         CASE WHEN max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1 THEN 'Yes' ELSE 'No' END AS rain_today
  FROM events GROUP BY 1, 2)"""


def metric_rows(spark: SparkSession, sf_dir: str):
    """(regression, classification) metric rows: one model per line number, one run per ship year.

    The regression model guesses the price from the quantity, the classifier
    guesses a returned item from the discount.
    """
    from obsledger.operators.evaluate import classification_metrics, regression_metrics
    from obsledger.operators.reshape import metrics_long

    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("run_"), F.year("l_shipdate").cast("string")).alias("run_id"),
        F.concat(F.lit("model"), F.col("l_linenumber").cast("string")).alias("model_name"),
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1000).alias("p"),
        (F.col("l_returnflag") == "R").cast("int").alias("yc"),
        ((F.col("l_discount") * 100 + F.col("l_linenumber")) > 10).cast("int").alias("pc"))
    by = ["run_id", "model_name"]
    reg = regression_metrics(li, "y", "p", by)
    cls = classification_metrics(li, "yc", "pc", by)
    return (metrics_long(reg, F.col("run_id"), F.col("model_name"), ["mse", "rmse", "mae", "r2"]),
            metrics_long(cls, F.col("run_id"), F.col("model_name"), ["accuracy", "precision", "recall", "f1"]))


METRICS = """scored AS (
  SELECT 'run_' || CAST(year(l_shipdate) AS VARCHAR) AS run_id, 'model' || CAST(l_linenumber AS VARCHAR) AS model_name,
         l_extendedprice AS y, l_quantity * 1000 AS p,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS yc,
         CASE WHEN l_discount * 100 + l_linenumber > 10 THEN 1 ELSE 0 END AS pc
  FROM lineitem),
regw AS (
  SELECT run_id, model_name, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
         avg(abs(y - p)) AS mae, 1 - avg((y - p) * (y - p)) / nullif(var_pop(y), 0) AS r2
  FROM scored GROUP BY 1, 2),
clsc AS (
  SELECT run_id, model_name, CAST(count(*) AS DOUBLE) AS n,
         CAST(count(*) FILTER (yc = pc) AS DOUBLE) AS hit,
         CAST(count(*) FILTER (yc = 1 AND pc = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (yc = 0 AND pc = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (yc = 1 AND pc = 0) AS DOUBLE) AS fn
  FROM scored GROUP BY 1, 2),
clsw AS (
  SELECT run_id, model_name, hit / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
         coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
  FROM clsc),
reg AS (
  SELECT run_id, model_name, 'mse' AS metric, mse AS value FROM regw
  UNION ALL SELECT run_id, model_name, 'rmse', rmse FROM regw
  UNION ALL SELECT run_id, model_name, 'mae', mae FROM regw
  UNION ALL SELECT run_id, model_name, 'r2', r2 FROM regw),
cls AS (
  SELECT run_id, model_name, 'accuracy' AS metric, accuracy AS value FROM clsw
  UNION ALL SELECT run_id, model_name, 'precision', "precision" FROM clsw
  UNION ALL SELECT run_id, model_name, 'recall', recall FROM clsw
  UNION ALL SELECT run_id, model_name, 'f1', f1 FROM clsw)"""


def rounded(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    """Round computed doubles, whose last digits depend on the order of summing."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
