"""Long / wide / nested shapes and row-key joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.scalars import publish_round, strip_prefix


def align(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Put two result frames side by side on their row key."""
    return left.join(right, list(key))


def enrich(df: DataFrame, on: str, dim: DataFrame, name: str, adds: Sequence[str],
           defaults: Mapping | None = None) -> DataFrame:
    """Add dimension columns by case-insensitive name, with defaults for unknown names."""
    small = dim.select(F.lower(F.col(name)).alias("_name"), *adds)
    out = df.withColumn("_name", F.lower(F.col(on))).join(small, "_name", "left").drop("_name")
    for col, value in (defaults or {}).items():
        out = out.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return out


def known_entities(df: DataFrame, entity: str, known: DataFrame, name: str) -> DataFrame:
    """Rows whose entity is listed in ``known``."""
    return df.join(known.select(F.col(name).alias(entity)).distinct(), entity, "left_semi")


def melt_onehot(df: DataFrame, prefix: str, keep: Sequence[str], out: str) -> DataFrame:
    """One-hot columns back to one category column; rows without a hot column disappear."""
    hot = [c for c in df.columns if c.startswith(prefix)]
    names = F.filter(F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in hot]), lambda x: x.isNotNull())
    return (df.select(*keep, F.explode(names).alias("_hot"))
              .select(*keep, strip_prefix("_hot", prefix).alias(out)))


def concat_rows(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def metrics_long(df: DataFrame, run_id: str | Column, model: str | Column, metrics: Sequence[str]) -> DataFrame:
    """Wide metric columns to (run_id, model_name, metric, value) rows."""
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return (df.select(as_col(run_id).alias("run_id"), as_col(model).alias("model_name"), F.explode(rows).alias("r"))
              .select("run_id", "model_name", "r.metric", "r.value"))


def metrics_wide(df: DataFrame, names: Sequence[str], by: Sequence[str] = ("model_name",)) -> DataFrame:
    """(.., metric, value) rows to one row per model with the listed metrics as columns."""
    return df.groupBy(*by).agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names])


def nest_forecast(df: DataFrame, entity: str, date: str, fields: Mapping[str, str], rain: str,
                  by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """One row per (.., entity) with its days as an ordered array of structs, values rounded.

    A forecast holds a few days per entity; ``by`` (such as the forecast id)
    keeps different forecasts apart, so arrays stay as short as the horizon.
    """
    day = F.struct(F.date_format(date, "yyyy-MM-dd").alias("date"),
                   *[publish_round(src, digits).alias(out) for out, src in fields.items()],
                   F.coalesce(F.col(rain), F.lit("Unknown")).alias("rain_forecast"))
    return df.groupBy(*by, F.col(entity).alias("location")).agg(F.array_sort(F.collect_list(day)).alias("days"))


def unnest_forecast(df: DataFrame, keep: Sequence[str] = ("location",), days: str = "days") -> DataFrame:
    """Arrays of day structs back to one row per day."""
    return df.select(*keep, F.inline(days))


def latest_version(df: DataFrame, version: str = "version") -> DataFrame:
    """Rows of the newest version; on a partitioned table only that partition is read."""
    newest = df.select(version).agg(F.max(version).alias("v")).scalar()
    return df.where(F.col(version) == newest)


def latest_forecast(df: DataFrame, forecast_id: str = "forecast_id", generated: str = "generated_at") -> DataFrame:
    """All rows of the forecast generated last (ties: largest id)."""
    newest = df.agg(F.max(F.struct(generated, forecast_id)).getField(forecast_id).alias("id")).scalar()
    return df.where(F.col(forecast_id) == newest)
