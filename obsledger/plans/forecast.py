"""Several-day forecast job: features, joint fit, forecast per entity, publishing form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.models.horizons import (
    HorizonModels, entity_codes, fit_horizons, forecast_features, horizon_targets, predict_wide, sequence_forecast,
)
from obsledger.operators.metering import Meter
from obsledger.operators.reshape import nest_forecast
from obsledger.operators.timeline import first_n
from obsledger.roles import HORIZONS, Roles


def train(df: DataFrame, roles: Roles, variables: Sequence[str], entities: Sequence | None = None,
          range_of: tuple[str, str] | None = None, horizons: Sequence[int] = HORIZONS, **kw):
    """(models, feature frame, feature names, entity codes)."""
    codes = entity_codes(df if not entities else df.where(F.col(roles.entity).isin(*entities)), roles.entity)
    featured, features = forecast_features(df, roles, entities, range_of, codes)
    rows, targets, labels = horizon_targets(featured, roles, variables, horizons)
    return fit_horizons(rows, features, targets, labels, **kw), featured, features, codes


def metered_train(df: DataFrame, roles: Roles, variables: Sequence[str], run_id: str, **how):
    """(what ``train`` returns, metric rows): training seconds, then seconds and rows of one prediction of all rows, and model bytes."""
    meter, name = Meter(df.sparkSession, run_id), "ThreeDayForecast"
    trained = meter.step(name, "training_time_seconds", lambda: train(df, roles, variables, **how))
    models, featured, _, _ = trained
    watched = meter.watch(predict_wide(featured, models, [roles.entity]), name)
    meter.step(name, "prediction_time_seconds", lambda: watched.write.format("noop").mode("overwrite").save())
    meter.value(name, "n_models", models.weights.select("target").distinct().count())
    meter.size(name, models.weights)
    return trained, meter.rows()


def latest_rows(df: DataFrame, roles: Roles) -> DataFrame:
    """Last row of every entity: the starting point of its forecast."""
    return first_n(df, roles.entity, [F.desc(c) for c in roles.order()], 1)


def forecast_entities(models: HorizonModels, rows: DataFrame, roles: Roles, variables: Sequence[str],
                      days: int = 3, location=None, longest: int = 3) -> DataFrame:
    """Day-by-day forecast with dates for one or all entities."""
    if location is not None:
        rows = rows.where(F.col(roles.entity) == location)
    out = sequence_forecast(rows, models, [roles.entity, roles.date], variables, days, longest)
    return out.withColumn("forecast_date", F.date_add(F.col(roles.date).cast("date"), F.col("Day")))


def on_demand(models: HorizonModels, rows: DataFrame, roles: Roles, variables: Sequence[str],
              fields: Mapping[str, str], days: int = 3, location=None) -> DataFrame:
    """Nested forecast of one or every location from its latest row; at most 3 days ahead."""
    if not 1 <= days <= 3:
        raise ValueError("days must be between 1 and 3")
    flat = forecast_entities(models, latest_rows(rows, roles), roles, variables, days, location)
    return nest_forecast(flat, roles.entity, "forecast_date", fields, "rain_forecast")
