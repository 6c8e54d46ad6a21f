"""Metric catalogue: runs, combined and canonical metrics, rankings, read queries."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsledger.functions.scalars import (
    grade_accuracy, grade_r2, lenient_double, precision_recall_balance, same_text,
)
from obsledger.operators.reshape import metrics_wide
from obsledger.operators.stats import scalar_row
from obsledger.roles import RUN_SCHEMA

# Canonical metric names and the names the positive class uses.
REGRESSION_METRICS = ("r2", "mse", "rmse", "mae", "mape", "training_time", "prediction_time")
CLASSIFICATION_METRICS = ("accuracy", "precision", "recall", "f1", "auc", "training_time", "prediction_time")
EXTRA_ALIASES = {
    "prediction_time": ("prediction_time_seconds",), "training_time": ("training_time_seconds",),
    "precision": ("precision_rain",), "recall": ("recall_rain",), "f1": ("f1_rain",),
}
IMPORTANCE_KEYS = ("coefficients", "feature_importance", "coef", "feature_importances")
CONFUSION_KEYS = ("confusion_matrix", "cm", "conf_matrix")
LINEAR_SVR_SETTINGS = {
    "kernel": "linear", "C": "1.0",
    "sampling": "30% of the rows when there are more than 50,000 (off by default)",
}


def new_run(spark: SparkSession, description: str = "") -> DataFrame:
    """One row for the run registry: uuid, UTC start time, description."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(str(uuid.uuid4()), now, description)], RUN_SCHEMA)


def combine_metrics(frames: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """Metric rows of several models under their registered names, tagged by type."""
    out = None
    for name, df in frames.items():
        part = df.select("run_id", F.lit(name).alias("model_name"), "metric", "value", F.lit(kind).alias("type"))
        out = part if out is None else out.unionByName(part)
    return out


def alias_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(alias, metric, precedence, needs_model) rows: name, NAME, name_score, <model>_name, extra names."""
    rows = []
    for m in names:
        plain = [m, m.upper(), f"{m}_score"]
        rows += [(a, m, i, False) for i, a in enumerate(plain)]
        rows.append((m, m, len(plain), True))
        rows += [(a, m, len(plain) + 1 + i, False) for i, a in enumerate(EXTRA_ALIASES.get(m, ()))]
    return spark.createDataFrame(rows, "alias string, canonical string, precedence int, needs_model boolean")


def canonical_metrics(df: DataFrame, names: Sequence[str], by: Sequence[str] = ("run_id", "model_name")) -> DataFrame:
    """Metric rows under canonical names; when several aliases are present the first one wins."""
    aliases = F.broadcast(alias_table(df.sparkSession, names))  # a few rows per metric name
    prefix = F.concat(F.col("model_name"), F.lit("_"))
    prefixed = F.col("metric").startswith(prefix)
    bare = F.when(prefixed, F.expr("substring(metric, length(model_name) + 2)"))
    both = df.select(*by, "metric", "value", F.explode(F.array(
        F.struct(F.col("metric").alias("alias"), F.lit(False).alias("needs_model")),
        F.struct(bare.alias("alias"), F.lit(True).alias("needs_model")))).alias("k"))
    hits = both.select(*by, "value", "k.*").join(aliases, ["alias", "needs_model"])
    return (hits.groupBy(*by, F.col("canonical").alias("metric"))
                .agg(F.min_by("value", "precedence").alias("value")))


def pick_document(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """First present of several document columns (coefficients, confusion matrices) under one name."""
    have = [k for k in keys if k in df.columns]
    kept = [c for c in df.columns if c not in have]
    return df.select(*kept, *([F.coalesce(*have).alias(out)] if have else []))


def performance_summary(df: DataFrame) -> DataFrame:
    """Per type: number of models, best model and its score (regression r2, classification f1; missing = 0).

    ``df`` holds canonical metric rows with a type column. Ties go to the first name.
    """
    score = (F.when((F.col("type") == "regression") & (F.col("metric") == "r2"), F.col("value"))
              .when((F.col("type") == "classification") & (F.col("metric") == "f1"), F.col("value")))
    per_model = df.groupBy("type", "model_name").agg(F.coalesce(F.max(score), F.lit(0.0)).alias("score"))
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("model_name")))
    return per_model.groupBy("type").agg(
        F.count(F.lit(1)).alias("n_models"), best["model_name"].alias("best_model"),
        F.max("score").alias("best_score"))


def rank_models(df: DataFrame) -> DataFrame:
    """Regression models by r2 with rank, explained share in percent and grade; ties by name.

    One row per model in a catalogue, so one ordered window is enough.
    """
    wide = metrics_wide(df, ["r2", "mse"]).where(F.col("r2").isNotNull())
    w = W.orderBy(F.desc("r2"), F.col("model_name"))
    return wide.select("model_name", "r2", "mse", F.row_number().over(w).alias("rank"),
                       (F.col("r2") * 100).alias("explained_pct"), grade_r2("r2").alias("grade"))


def best_classifier(df: DataFrame) -> DataFrame:
    """Best model by f1, else accuracy, with its grade and precision-recall balance."""
    wide = metrics_wide(df, ["accuracy", "precision", "recall", "f1"])
    score = F.coalesce("f1", "accuracy", F.lit(0.0))
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("accuracy", "precision", "recall", "f1")}
    top = wide.withColumn("score", score).orderBy(F.desc("score"), "model_name").limit(1)
    return top.select("model_name", "score", *[v.alias(c) for c, v in zero.items()],
                      grade_accuracy(zero["accuracy"]).alias("grade"),
                      precision_recall_balance(zero["precision"], zero["recall"]).alias("balance"))


def comparison_series(df: DataFrame) -> DataFrame:
    """(model, r2, mse) rows behind a comparison chart; models without r2 stay out."""
    return (metrics_wide(df, ["r2", "mse"]).where(F.col("r2").isNotNull())
            .select(F.col("model_name").alias("model"), "r2", F.coalesce("mse", F.lit(0.0)).alias("mse")))


# ---- read queries ------------------------------------------------------------------

def metrics(df: DataFrame, run_id: str | None = None, model: str | None = None) -> DataFrame:
    """Metric rows of a run and / or model."""
    if run_id:
        df = df.where(F.col("run_id") == run_id)
    if model:
        df = df.where(F.col("model_name") == model)
    return df


def model_metrics(regression: DataFrame, classification: DataFrame, model: str, kind: str | None = None) -> DataFrame:
    """Rows of one model from both metric tables, tagged by type; ``kind`` keeps one of them."""
    out = (regression.withColumn("type", F.lit("regression"))
           .unionByName(classification.withColumn("type", F.lit("classification")))
           .where(F.col("model_name") == model))
    return out if kind is None else out.where(same_text("type", F.lit(kind)))


def model_settings(spark: SparkSession, model: str) -> DataFrame:
    """Settings shown beside the metrics of the linear SVR; empty for other models."""
    rows = list(LINEAR_SVR_SETTINGS.items()) if model.lower() in ("svm", "svr") else []
    return spark.createDataFrame(rows, "setting string, value string")


def runs(*metric_frames: DataFrame) -> DataFrame:
    """Distinct run ids over the metric tables, sorted."""
    out = metric_frames[0].select("run_id")
    for df in metric_frames[1:]:
        out = out.union(df.select("run_id"))
    return out.distinct().orderBy("run_id")


def metric_defaults(df: DataFrame, defaults: Mapping) -> DataFrame:
    """Every default column present; absent or missing values take the default."""
    have = set(df.columns)
    filled = [(F.coalesce(F.col(c), F.lit(v)) if c in have and v is not None
               else F.col(c) if c in have else F.lit(v)).alias(c) for c, v in defaults.items()]
    return df.select(*[c for c in df.columns if c not in defaults], *filled)


def numeric_metrics(df: DataFrame, value: str = "value", default: float = 0.0) -> DataFrame:
    """Text metric values read as numbers, unreadable ones as ``default``."""
    return df.withColumn(value, lenient_double(value, default))


def series(df: DataFrame, metric: str, by: Sequence[str] = ("run_id", "model_name")) -> DataFrame:
    """Mean of one metric per run and model."""
    return df.where(F.col("metric") == metric).groupBy(*by).agg(F.avg("value").alias("value"))


def scaled_series(df: DataFrame) -> DataFrame:
    """Mean of every metric per model and its min-max scaled value among the models."""
    means = df.groupBy("metric", "model_name").agg(F.avg("value").alias("value"))
    span = means.groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return means.join(span, "metric").select(
        "metric", "model_name", "value",
        F.coalesce(F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0)).alias("scaled"))


def confusion_from_scores(df: DataFrame) -> DataFrame:
    """Confusion counts recovered from precision, recall, positives and total rows."""
    tp = F.round(F.col("recall") * F.col("positives"))
    said = F.round(F.try_divide(tp, F.col("precision")))
    out = df.withColumn("tp", tp).withColumn("fp", F.coalesce(said - F.col("tp"), F.lit(0.0)))
    return (out.withColumn("fn", F.col("positives") - F.col("tp"))
               .withColumn("tn", F.col("n") - F.col("tp") - F.col("fp") - F.col("fn")))


def result_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the stored result tables."""
    names = [(t.name,) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(sorted(names), "table_name string")


def run_scalar(df: DataFrame):
    """Run id of a one-row registry frame as a scalar column."""
    return scalar_row(df.select("run_id"))["run_id"]
