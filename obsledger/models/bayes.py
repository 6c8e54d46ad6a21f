"""Gaussian naive Bayes for a 0/1 label, fitted in one grouped pass and scored by expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsledger.functions.scalars import date_text, int_to_yesno
from obsledger.roles import Roles

# Fixed value: share of the largest variance added to every variance.
VAR_SMOOTHING = 1e-9


def fit_bayes(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row per class: n, prior share, and mean / variance arrays in feature order."""
    rows = df.where(F.col(label).isNotNull())
    groups = rows.groupBy(F.col(label).cast("int").alias("class")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(f) for f in features]).alias("mean"),
        F.array(*[F.var_pop(f) for f in features]).alias("raw_var"))
    # population variance of all rows from the class moments; one row per class
    every = W.partitionBy()
    n = F.sum("n").over(every)
    spreads = []
    for i in range(len(features)):
        m, v = F.col("mean")[i], F.col("raw_var")[i]
        centre = F.sum(F.col("n") * m).over(every) / n
        spreads.append(F.sum(F.col("n") * (v + m * m)).over(every) / n - centre * centre)
    smooth = F.array_max(F.array(*spreads)) * VAR_SMOOTHING
    return groups.withColumns({"all": n, "smooth": smooth}).select(
        "class", "n", (F.col("n") / F.col("all")).alias("share"), "mean",
        F.transform("raw_var", lambda v: v + F.col("smooth")).alias("var"),
        F.array(*[F.lit(f) for f in features]).alias("features"))


def _likelihood(fitted, features: Sequence[str]) -> Column:
    """Log prior plus log density of one class, with the fitted numbers as constants."""
    total = F.lit(fitted["constant"])
    for i, f in enumerate(features):
        gap = F.col(f) - fitted["mean"][i]
        if fitted["var"][i]:  # a measure without any spread tells nothing
            total = total - gap * gap / (2 * fitted["var"][i])
    return total


def predict_bayes(df: DataFrame, params: DataFrame, features: Sequence[str],
                  label_out: str = "prediction", prob_out: str = "probability") -> DataFrame:
    """Add the predicted class and P(class 1). A tie goes to class 0. Without any fitted class both are missing."""
    spread = [F.col("var")[i] for i in range(len(features))]
    log_terms = sum((F.when(v == 0, 0.0).otherwise(F.log(2 * F.pi() * v)) for v in spread), F.lit(0.0))
    ready = params.select("class", "mean", "var", (F.log("share") - log_terms * 0.5).alias("constant"))
    fitted = {r["class"]: r for r in ready.collect()}  # one row per class
    if len(fitted) == 2:
        prob = 1 / (1 + F.exp(_likelihood(fitted[0], features) - _likelihood(fitted[1], features)))
    else:  # only one class was ever seen, or none
        prob = F.lit(float(next(iter(fitted))) if fitted else None).cast("double")
    return df.withColumn(prob_out, prob).withColumn(label_out, (F.col(prob_out) > 0.5).cast("int"))


def predict_next_day(df: DataFrame, params: DataFrame, features: Sequence[str], roles: Roles,
                     date: str | None = None) -> DataFrame:
    """Next-day label and probability for the rows of one date (default: the latest).

    Missing features are filled with the mean of that day's rows. A date
    without rows gives no rows.
    """
    from obsledger.operators.clean import impute

    d = F.col(roles.date).cast("date")
    day = F.lit(date).cast("date") if date else df.agg(F.max(d).alias("m")).scalar()
    today = impute(df.where(d == day), features, "mean")
    scored = predict_bayes(today, params, features)
    return scored.select(
        roles.entity, roles.date, date_text(roles.date, 1).alias("NextDate"),
        int_to_yesno("prediction").alias("RainTomorrow_Prediction"),
        F.col("probability").alias("RainTomorrow_Probability"))


def next_day_or_error(df: DataFrame, params: DataFrame, features: Sequence[str], roles: Roles, date: str | None = None) -> DataFrame:
    """``predict_next_day`` with a column ``error``; a date without rows gives one row that says so."""
    found = predict_next_day(df, params, features, roles, date)
    d = F.col(roles.date).cast("date")
    asked = F.lit(date).cast("date") if date else df.agg(F.max(d).alias("m")).scalar()
    none = df.where(d == asked).agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    text = F.concat(F.lit("No hay datos para la fecha "), F.coalesce(F.date_format(asked, "yyyy-MM-dd"), F.lit("")))
    missing = none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields], text.alias("error"))
    return found.withColumn("error", F.lit(None).cast("string")).unionByName(missing)


def predict_rows(df: DataFrame, params: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add label and probability to any rows (such as synthetic ones), filling gaps with the batch mean."""
    from obsledger.operators.clean import impute

    scored = predict_bayes(impute(df, features, "mean"), params, features)
    return scored.select(*df.columns, int_to_yesno("prediction").alias("RainTomorrow_Prediction"),
                         F.col("probability").alias("RainTomorrow_Probability"))
