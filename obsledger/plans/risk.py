"""Climate-risk jobs: next-day label models and the risk index per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.scalars import yesno_to_int
from obsledger.models import bayes, regress, trees
from obsledger.models.scale import fit_scaler, scale
from obsledger.operators.aggregate import risk_index
from obsledger.operators.clean import drop_missing, impute_coerced_mean
from obsledger.operators.evaluate import classification_metrics, confusion, report_of_cells
from obsledger.operators.metering import Meter
from obsledger.operators.timeline import hash_split, next_day_label, positional_split
from obsledger.roles import Roles
from obsledger.session import cut_lineage

SCORES = ("accuracy", "precision", "recall", "f1")


def forest_risk(features: DataFrame, roles: Roles, measures: Sequence[str], run_id: str, **forest):
    """(metric rows, risk index, forest) of the label forest, 100 trees of any depth unless told otherwise, on prepared rows."""
    label = f"{roles.label}_01"
    rows = features.withColumn(label, yesno_to_int(roles.label))
    keys = [roles.entity, roles.date, *roles.key]
    ready = regress.prepare_inference(rows, roles.entity, measures, roles.today, keys=[*keys, label])
    train, test = hash_split(drop_missing(ready, [label]), keys)
    meter, name = Meter(features.sparkSession, run_id), "RandomForestClassifier"
    model = meter.step(name, "training_time_seconds", lambda: trees.fit_forest(
        train, [*measures, roles.today, *regress.CALENDAR], label, keys, entity=roles.entity, draw="sqrt", **forest))
    scored = meter.watch(trees.predict_label(model, test, "PredictedRainTomorrow"), name)
    scores = meter.step(name, "prediction_time_seconds", lambda: classification_metrics(scored, label, "PredictedRainTomorrow").first())
    meter.values(name, {m: scores[m] for m in SCORES})
    meter.size(name, model.nodes)
    predicted = trees.predict_label(model, ready, "PredictedRainTomorrow")
    return meter.rows(), risk_index(predicted, roles.entity, "PredictedRainTomorrow", run_id), model


def bayes_rows(raw: DataFrame, roles: Roles, use_given_label: bool = False) -> DataFrame:
    """Rows for naive Bayes: joined (or given) next-day label as 0/1, today's label 0/1, means filled."""
    given = roles.label if use_given_label else "_next"
    rows = raw if use_given_label else next_day_label(raw, roles.entity, roles.date, roles.today, given)
    rows = drop_missing(rows, [given]).withColumns(
        {"label": yesno_to_int(given), roles.today: yesno_to_int(roles.today)})
    return impute_coerced_mean(rows, [*roles.measures, roles.today])


def bayes_next_day(raw: DataFrame, roles: Roles, run_id: str, key: str):
    """(parameters, metric rows, test predictions) of naive Bayes on the first 80 % of sorted rows."""
    rows = bayes_rows(raw, roles)
    features = [c for c in (*roles.measures, roles.today) if c in rows.columns]
    split = positional_split(rows, roles.entity, roles.date, key)
    train = split.where("is_train = 1")
    scaler = fit_scaler(train, features)
    meter, name = Meter(raw.sparkSession, run_id), "NaiveBayes"
    params = meter.step(name, "training_time_seconds", lambda: cut_lineage(bayes.fit_bayes(scale(train, scaler), features, "label")))
    scored = bayes.predict_bayes(scale(split.where("is_train = 0"), scaler), params, features)
    watched = meter.watch(scored, name)
    classes = meter.step(name, "prediction_time_seconds", lambda: confusion(watched, "label", "prediction").collect())  # four cells
    cells = raw.sparkSession.createDataFrame(classes, "actual int, predicted int, n long") if classes else None
    if cells is not None:
        by_class = {r["class"]: r for r in report_of_cells(cells).collect()}
        hits, total = sum(r["n"] for r in classes if r["actual"] == r["predicted"]), sum(r["n"] for r in classes)
        meter.value(name, "accuracy", hits / total)
        for value, suffix in ((0, "_no_rain"), (1, "_rain")):
            if value in by_class:
                meter.values(name, {f"{m}{suffix}": by_class[value][m] for m in ("precision", "recall", "f1")})
        if 1 in by_class:
            meter.values(name, {m: by_class[1][m] for m in ("precision", "recall", "f1")})
    meter.size(name, params)
    return params, meter.rows(), scored


def risk_by_bayes(df: DataFrame, features: Sequence[str], label: str, entity: str, run_id: str = "run_001") -> DataFrame:
    """Mean predicted probability per entity from a naive Bayes model of the same rows."""
    params = bayes.fit_bayes(df, features, label)
    scored = bayes.predict_bayes(df, params, features)
    return risk_index(scored.select(entity, F.col("probability")), entity, "probability", run_id)
