"""The regression family: same input and split, five learners, one metric table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from obsledger.models import margin, regress, trees
from obsledger.operators.evaluate import regression_metrics
from obsledger.operators.metering import Meter
from obsledger.operators.timeline import hash_split, sample_rows
from obsledger.plans.prepare import regression_input

SCORES = ("mse", "rmse", "mae", "r2")
MODEL_NAMES = {"ols": "LinearRegression", "multiple": "MultipleRegression", "tree": "DecisionTreeRegressor",
               "forest": "RandomForestRegressor", "svr": "SVM"}


def run_regressions(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], run_id: str,
                    kinds: Sequence[str] = ("ols", "tree", "forest", "svr"),
                    params: Mapping[str, Mapping] | None = None, svr_share: float = 1.0) -> DataFrame:
    """Metric rows of the chosen learners on a hashed 80 / 20 split; ``svr_share`` below 1 fits the SVR on that share.

    Beside the scores every model has its training and prediction seconds, the rows it scored and its size in bytes.
    Fits and scores each model.
    """
    rows = regression_input(df, features, target, keys)
    train, test = hash_split(rows, keys)
    meter = Meter(df.sparkSession, run_id)
    for kind in kinds:
        extra, name = dict((params or {}).get(kind, {})), MODEL_NAMES[kind]
        if kind == "svr":
            pool = sample_rows(train, keys, svr_share) if svr_share < 1 else train
            parameters = meter.step(name, "training_time_seconds", lambda: margin.fit_svr(pool, features, target, **extra))
            scored = margin.predict_margin(test, parameters, "_hat").withColumnRenamed(f"{target}_hat", "prediction")
        elif kind in ("tree", "forest"):  # of any depth
            settings = {"trees": 1 if kind == "tree" else 100, **extra}
            model = meter.step(name, "training_time_seconds", lambda: trees.fit_forest(train, features, target, keys, **settings))
            scored, parameters = trees.predict(model, test), model.nodes
        else:
            model = meter.step(name, "training_time_seconds", lambda: regress.fit_regressor(train, features, target, "ols", **extra))
            scored, parameters = regress.predict(model, test), regress.coefficients(model, df.sparkSession)
        watched = meter.watch(scored, name)
        scores = meter.step(name, "prediction_time_seconds", lambda: regression_metrics(watched, target, "prediction").first())
        meter.values(name, {s: scores[s] for s in SCORES})
        meter.size(name, parameters)
    return meter.rows()
