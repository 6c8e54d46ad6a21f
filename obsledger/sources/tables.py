"""Stored result tables: runs, metrics, risk index, forecasts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from obsledger.operators.publish import forecast_records
from obsledger.roles import FORECAST_SCHEMA


def append_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Append to a managed table, made on the first write."""
    writer = df.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Append the same frame to an external SQL table."""
    df.write.jdbc(url, table, mode="append", properties=dict(properties or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def ensure_forecast_table(spark: SparkSession, name: str = "weather_forecasts") -> None:
    """Create the forecast table when it is absent."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FORECAST_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet")


def save_forecast(nested: DataFrame, name: str = "weather_forecasts", forecast_id: str | None = None) -> int:
    """Append a nested forecast as one write; returns the number of stored rows.

    The rows are counted from the table by the new forecast id, so the forecast
    is computed once.
    """
    spark = nested.sparkSession
    ensure_forecast_table(spark, name)
    fid = forecast_id or str(uuid.uuid4())
    rows = forecast_records(nested, fid)
    rows.write.mode("append").insertInto(name)
    return query(spark, f"SELECT * FROM {name} WHERE forecast_id = :fid", fid=fid).count()


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SQL read with bound parameters (``:name``)."""
    return spark.sql(sql, args=args)
