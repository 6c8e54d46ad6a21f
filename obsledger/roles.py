"""Column roles of an observation table and the daily-weather preset."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in an observation table."""

    entity: str
    date: str
    key: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()
    categoricals: tuple[str, ...] = ()
    label: str | None = None
    today: str | None = None
    extra: dict = field(default_factory=dict)

    def order(self) -> list[str]:
        """Total order of rows inside one entity."""
        return [self.date, *self.key]


# Canonical column names of a daily weather observation.
WEATHER_MEASURES = (
    "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine", "WindGustSpeed",
    "WindSpeed9am", "WindSpeed3pm", "Humidity9am", "Humidity3pm", "Pressure9am",
    "Pressure3pm", "Cloud9am", "Cloud3pm", "Temp9am", "Temp3pm",
)
CLUSTER_MEASURES = tuple(m for m in WEATHER_MEASURES if not m.startswith("Cloud"))
REGRESSION_FEATURES = ("MinTemp", "Rainfall", "Humidity3pm", "WindGustSpeed")
FORECAST_VARIABLES = (
    "MinTemp", "MaxTemp", "Rainfall", "Humidity9am", "Humidity3pm",
    "Pressure9am", "Pressure3pm", "WindSpeed9am", "WindSpeed3pm",
)
COHERENT_VARIABLES = ("MinTemp", "MaxTemp", "Pressure9am", "Pressure3pm", "Temp9am", "Temp3pm")
FORECAST_ENTITIES = (
    "Sydney", "Melbourne", "Brisbane", "Perth", "Adelaide", "Hobart", "Darwin", "Canberra",
)
HORIZONS = (1, 2, 3)

WEATHER = Roles(
    entity="Location",
    date="Date",
    measures=WEATHER_MEASURES,
    categoricals=("WindGustDir", "WindDir9am", "WindDir3pm", "RainToday"),
    label="RainTomorrow",
    today="RainToday",
)


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def _schema(spec: str) -> T.StructType:
    """Schema from "name type, ..." text; needs no running session."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Table layouts.
OBSERVATION_SCHEMA = _schema(
    "Date string, Location string, MinTemp double, MaxTemp double, Rainfall double, "
    "Evaporation double, Sunshine double, WindGustDir string, WindGustSpeed double, "
    "WindDir9am string, WindDir3pm string, WindSpeed9am double, WindSpeed3pm double, "
    "Humidity9am double, Humidity3pm double, Pressure9am double, Pressure3pm double, "
    "Cloud9am double, Cloud3pm double, Temp9am double, Temp3pm double, "
    "RainToday string, RISK_MM double, RainTomorrow string"
)
RUN_SCHEMA = _schema("run_id string, started_at timestamp, description string")
METRIC_SCHEMA = _schema("run_id string, model_name string, metric string, value double")
RISK_SCHEMA = _schema("run_id string, city string, climate_risk_index double")
FORECAST_SCHEMA = _schema(
    "id string, forecast_id string, generated_at timestamp, location string, forecast_date date, "
    "min_temp double, max_temp double, rainfall_mm double, humidity_9am double, "
    "humidity_3pm double, pressure_9am double, pressure_3pm double, wind_speed_9am double, "
    "wind_speed_3pm double, rain_forecast string, model_name string, created_at timestamp"
)
PLACE_SCHEMA = _schema("id string, name string, state string, latitude double, longitude double")
PLACES = [
    ("1", "Sydney", "NSW", -33.8688, 151.2093),
    ("2", "Melbourne", "VIC", -37.8136, 144.9631),
    ("3", "Brisbane", "QLD", -27.4698, 153.0251),
    ("4", "Perth", "WA", -31.9505, 115.8605),
    ("5", "Adelaide", "SA", -34.9285, 138.6007),
    ("6", "Hobart", "TAS", -42.8821, 147.3272),
    ("7", "Darwin", "NT", -12.4634, 130.8456),
    ("8", "Canberra", "ACT", -35.2809, 149.1300),
]
PLACE_DEFAULTS = {"state": "NSW", "latitude": -33.8688, "longitude": 151.2093}
# Published forecast field -> observation column.
FORECAST_FIELDS = {
    "min_temp": "MinTemp", "max_temp": "MaxTemp", "rainfall_mm": "Rainfall",
    "humidity_9am": "Humidity9am", "humidity_3pm": "Humidity3pm",
    "pressure_9am": "Pressure9am", "pressure_3pm": "Pressure3pm",
    "wind_speed_9am": "WindSpeed9am", "wind_speed_3pm": "WindSpeed3pm",
}
