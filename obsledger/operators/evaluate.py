"""Model quality measures as single aggregates."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.operators.stats import scalar_row


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """n, mse, rmse, mae and r2 (missing when the target is constant).

    The total sum of squares comes from the population variance, so target
    mean and errors are found in the same pass.
    """
    err = F.col(y) - F.col(p)
    both = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    mse = F.avg(err * err)
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"), (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"))


def _scores(tp, fp, fn):
    precision = F.coalesce(F.try_divide(tp * 1.0, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp * 1.0, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(tp * 2.0, tp * 2 + fp + fn), F.lit(0.0))
    return precision, recall, f1


def classification_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), positive: int = 1) -> DataFrame:
    """n, accuracy, precision, recall and f1 of the positive class; 0 where undefined."""
    yes, said = F.col(y) == positive, F.col(p) == positive
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(y) == F.col(p)).alias("hit"),
        F.count_if(yes & said).alias("tp"), F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"))
    precision, recall, f1 = _scores(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.select(*by, "n", F.try_divide(F.col("hit") * 1.0, F.col("n")).alias("accuracy"),
                         precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """Rows per (actual, predicted) pair."""
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """precision, recall, f1 and support for every class, from the confusion counts."""
    return report_of_cells(confusion(df, y, p))


def report_of_cells(cells: DataFrame) -> DataFrame:
    """The class report of confusion counts (actual, predicted, n)."""
    sides = F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said"))))
    hit = cells.where("actual = predicted").select(F.col("actual").alias("class"), F.col("n").alias("tp"))
    sums = (cells.select(sides.alias("s")).select("s.*").groupBy("class")
                 .agg(F.sum("support").alias("support"), F.sum("said").alias("said")))
    tp = F.coalesce(F.col("tp"), F.lit(0))
    precision, recall, f1 = _scores(tp, F.col("said") - tp, F.col("support") - tp)
    return sums.join(hit, "class", "left").select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def forecast_error(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], variables: Sequence[str],
                   horizon: str | None = None) -> DataFrame:
    """MAE and RMSE per variable (and horizon) of a forecast joined to what happened.

    Both frames carry the same variable columns.
    """
    truth = actual.select(*keys, *[F.col(v).alias(f"_{v}") for v in variables])
    by = [horizon] if horizon else []
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), (F.col(v) - F.col(f"_{v}")).alias("err"))
                                for v in variables]))
    return (forecast.join(truth, list(keys)).select(*by, pairs.alias("r")).select(*by, "r.variable", "r.err")
            .where(F.col("err").isNotNull()).groupBy(*by, "variable")
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs("err")).alias("mae"),
                 F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("rmse")))


def label_agreement(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], label: str, horizon: str | None = None,
                    positive: str = "Yes") -> DataFrame:
    """n, accuracy, precision, recall and f1 of a forecast's label (such as rain) per horizon, joined to what happened.

    Days without a label on either side are left out.
    """
    truth = actual.select(*keys, F.col(label).alias("_truth"))
    both = forecast.join(truth, list(keys)).where(F.col(label).isNotNull() & F.col("_truth").isNotNull())
    coded = both.withColumns({"_y": (F.col("_truth") == positive).cast("int"), "_p": (F.col(label) == positive).cast("int")})
    return classification_metrics(coded, "_y", "_p", [horizon] if horizon else [])


def forecast_status(forecast: DataFrame, actual: DataFrame, date: str) -> DataFrame:
    """Forecast days, actual days and whether the forecast can be checked."""
    fc = scalar_row(forecast.agg(F.count_distinct(date).alias("n")))["n"]
    ac = actual.agg(F.count_distinct(date).alias("actual_days"))
    return ac.select(fc.alias("forecast_days"), "actual_days",
                     F.when((fc > 0) & (F.col("actual_days") > 0), "evaluated")
                      .otherwise("not_available").alias("status"))


def timed(action: Callable, name: str, run_id: str, model: str):
    """Run an action; returns (its result, one metric row tuple with the seconds it took)."""
    start = time.perf_counter()
    result = action()
    return result, (run_id, model, name, time.perf_counter() - start)
