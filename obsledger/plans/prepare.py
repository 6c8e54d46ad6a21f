"""Cleaning chains from raw observations to feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.scalars import parse_date
from obsledger.models.scale import fit_scaler, scale
from obsledger.operators.clean import add_calendar, clip_upper, flag_outliers, impute, select_available
from obsledger.operators.profile import columns_of
from obsledger.roles import CLUSTER_MEASURES

# Columns of the final feature table.
FINAL_COLUMNS = (
    "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine", "WindGustDir", "WindGustSpeed", "WindDir9am",
    "WindDir3pm", "WindSpeed9am", "WindSpeed3pm", "Humidity9am", "Humidity3pm", "Pressure9am", "Pressure3pm",
    "Cloud9am", "Cloud3pm", "Temp9am", "Temp3pm", "RainToday", "Year", "Month", "Season",
)


def clean_table(raw: DataFrame, date: str = "Date", skewed: Sequence[str] = ("Rainfall",),
                final: Sequence[str] = FINAL_COLUMNS, keys: Sequence[str] = ("Location", "Date")) -> DataFrame:
    """Median and mode fills, strict dates, clipped skewed measures, calendar columns, final selection.

    Row keys are kept beside the final columns.
    """
    df = impute(raw, columns_of(raw, "numeric"), "median")
    df = impute(df, columns_of(raw, "text"), "mode")
    df = df.withColumn(date, parse_date(date)) if date in columns_of(raw, "text") else df
    df = clip_upper(df, [c for c in skewed if c in df.columns])
    df = add_calendar(df, date, ("Year", "Month", "Day", "DayOfWeek"), labels="en")
    return select_available(df, list(dict.fromkeys([*keys, *final])))


def risk_features(raw: DataFrame, date: str = "Date", median_cols: Sequence[str] = ("MinTemp", "MaxTemp"),
                  mode_cols: Sequence[str] = ("RainToday",), skewed: str = "Rainfall") -> DataFrame:
    """24 raw columns to 31: filled, dated leniently, calendar and season added, outliers flagged."""
    df = impute(impute(raw, median_cols, "median"), mode_cols, "mode")
    df = df.withColumn(date, parse_date(date, lenient=True) if date in columns_of(raw, "text") else F.col(date).cast("date"))
    df = add_calendar(df, date, ("Year", "Month", "Day", "DayOfWeek", "Quarter"), labels="es")
    return flag_outliers(df, [skewed])


def cluster_input(df: DataFrame, cols: Sequence[str] = CLUSTER_MEASURES, keys: Sequence[str] = ("Location", "Date")) -> DataFrame:
    """Row keys and standardised measures, medians where missing."""
    have = [c for c in cols if c in df.columns]
    rows = impute(select_available(df, [*keys, *have]), have, "median")
    return scale(rows, fit_scaler(rows, have))


def regression_input(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """Row keys, features and target, medians where missing."""
    cols = [*features, target]
    return impute(select_available(df, [*keys, *cols]), cols, "median")


