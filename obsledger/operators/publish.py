"""Forecast documents, stored forecasts and the views read from them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.functions.scalars import lenient_double, precipitation_score, weather_condition
from obsledger.operators.reshape import enrich, latest_forecast, nest_forecast, unnest_forecast
from obsledger.operators.timeline import first_n
from obsledger.roles import FORECAST_FIELDS, FORECAST_SCHEMA, PLACE_DEFAULTS, PLACE_SCHEMA, PLACES, Roles

# Name stored with sequence forecasts and defaults of a location view.
SEQUENCE_MODEL = "SequentialForecastSVM"
VIEW_DEFAULTS = {"temperature_max": 25.0, "temperature_min": 15.0, "humidity": 60.0,
                 "precipitation": 30.0, "wind_speed": 15.0}
FORECAST_METRIC_DEFAULTS = {
    "temperature_mae": 0.0, "temperature_rmse": 0.0, "precipitation_accuracy": 0.0, "wind_speed_mae": 0.0,
    "humidity_mae": 0.0, "model_type": "ForecastSVM", "status": "not_available", "last_updated": None,
    "forecast_horizon_days": 3,
}


def places(spark: SparkSession) -> DataFrame:
    """The eight known locations."""
    return spark.createDataFrame(PLACES, PLACE_SCHEMA)


def forecast_document(nested: DataFrame, length: int, generated: str | None = None) -> DataFrame:
    """One JSON document per location: metadata, then its days.

    A document per location keeps every row as small as the horizon.
    """
    stamp = F.lit(generated) if generated else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    body = F.struct(stamp.alias("generated_at"), F.lit(length).alias("sequence_length"),
                    F.size("days").alias("n_predictions"), F.col("location"), F.col("days"))
    return nested.select("location", F.to_json(body).alias("document"))


def api_form(nested: DataFrame, length: int, generated: str | None = None) -> DataFrame:
    """Per location: status, generation time, model type, horizon, days."""
    stamp = F.lit(generated) if generated else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return nested.select(
        F.lit("success").alias("status"), stamp.alias("forecast_generated_at"),
        F.lit(length).alias("forecast_period_days"), F.lit("SVM").alias("model_type"), F.lit("1.0").alias("version"),
        "location", "days")


def forecast_records(nested: DataFrame, forecast_id: str | None = None, model: str = SEQUENCE_MODEL) -> DataFrame:
    """Nested forecast as rows of the stored forecast table, stamped with id, time and model."""
    flat = unnest_forecast(nested)
    fid = forecast_id or str(uuid.uuid4())
    given = {"forecast_id": F.lit(fid), "generated_at": F.current_timestamp(), "created_at": F.current_timestamp(),
             "forecast_date": F.col("date"), "model_name": F.lit(model),
             "id": F.concat_ws("_", F.lit(fid), F.col("location").cast("string"), F.col("date"))}
    cols = []
    for f in FORECAST_SCHEMA.fields:
        value = given.get(f.name, F.col(f.name) if f.name in flat.columns else F.lit(None))
        cols.append(value.cast(f.dataType).alias(f.name))
    return flat.select(*cols)


def stored_view(stored: DataFrame, location: str | None = None,
                fields: Sequence[str] = tuple(FORECAST_FIELDS)) -> DataFrame:
    """Latest stored forecast, optionally of one location, values rounded, nested per location."""
    rows = latest_forecast(stored)
    if location is not None:
        rows = rows.where(F.col("location") == location)
    return nest_forecast(rows, "location", "forecast_date", {f: f for f in fields}, "rain_forecast",
                         by=["forecast_id", "generated_at"])


def document_view(nested: DataFrame, location: str | None = None) -> DataFrame:
    """Days of one location of a nested forecast; the first location by name when none is given."""
    wanted = F.lit(location) if location is not None else nested.agg(F.min("location").alias("l")).scalar()
    return nested.where(F.col("location") == wanted)


def location_view(df: DataFrame, roles: Roles, fields: Mapping[str, str], location, default="Sydney",
                  n: int = 3, dim: DataFrame | None = None, name: str = "name",
                  adds: Sequence[str] = ("state", "latitude", "longitude"), defaults: Mapping | None = None,
                  cap: float | None = None) -> DataFrame:
    """First ``n`` days of a location (an unknown one falls back to ``default``) with wording and coordinates.

    ``fields`` maps temperature_max, temperature_min, humidity, precipitation,
    wind_speed and sunshine to columns; absent ones use the defaults.
    """
    known = df.where(F.col(roles.entity) == location).agg(F.count(F.lit(1)).alias("n")).scalar()
    chosen = F.when(known > 0, F.lit(location)).otherwise(F.lit(default))
    days = first_n(df.where(F.col(roles.entity) == chosen), roles.entity, roles.order(), n)
    dim = dim if dim is not None else places(df.sparkSession)
    defaults = PLACE_DEFAULTS if defaults is None else defaults
    known_values = {k: F.col(c) if c in df.columns else F.lit(None).cast("double") for k, c in fields.items()}

    def value(k):
        return lenient_double(known_values.get(k, F.lit(None).cast("double")), VIEW_DEFAULTS[k])

    rain = F.col(roles.today) if roles.today else F.lit("No")
    out = days.select(
        F.col(roles.entity).cast("string").alias("location"), F.date_format(roles.date, "yyyy-MM-dd").alias("date"),
        value("temperature_max").alias("temperature_max"), value("temperature_min").alias("temperature_min"),
        value("humidity").alias("humidity"),
        precipitation_score(value("precipitation"), cap=cap).alias("precipitation_score"),
        value("wind_speed").alias("wind_speed"),
        weather_condition(rain, known_values.get("sunshine", F.lit(None))).alias("weather_condition"))
    return enrich(out, "location", dim, name, list(adds), defaults)


def forecast_locations(forecast: DataFrame, name: str, dim: DataFrame, dim_name: str) -> DataFrame:
    """Known locations that occur in the forecast; all known ones when none does."""
    seen = forecast.select(F.lower(F.col(name)).alias("_n")).distinct()
    # the dimension is on the kept side, so the number of forecast rows does not matter
    hits = dim.join(seen.withColumn("_hit", F.lit(1)), F.lower(F.col(dim_name)) == F.col("_n"), "left").drop("_n")
    any_hit = hits.agg(F.max("_hit").alias("h")).scalar()
    return hits.where((F.col("_hit") == 1) | any_hit.isNull()).drop("_hit")


