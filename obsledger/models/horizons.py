"""Several-day forecasts: one linear model per variable and horizon, fitted together."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.scalars import rain_label, value_range, yesno_to_int
from obsledger.models.margin import fit_classifier, fit_margin, margin_column, platt_column, weights_of
from obsledger.operators.clean import add_calendar, conform, encode_code, filter_in, impute
from obsledger.operators.timeline import lead_targets, value_ranks
from obsledger.roles import HORIZONS, Roles


@dataclass(frozen=True)
class HorizonModels:
    """Weights of all regressors and label classifiers; a few numbers per target."""

    weights: DataFrame
    label_weights: DataFrame
    platt: Mapping[str, tuple[float, float]]
    seconds: float

    def targets(self) -> list[str]:
        return sorted([*weights_of(self.weights), *weights_of(self.label_weights)])


def entity_codes(df: DataFrame, entity: str) -> DataFrame:
    """(name, code) dimension: codes follow the sorted names; stored with the model."""
    names = df.select(F.col(entity).alias("name")).where(F.col("name").isNotNull()).distinct()
    return value_ranks(names, "name", "code", desc=False).select("name", (F.col("code") - 1).cast("int").alias("code"))


def forecast_features(df: DataFrame, roles: Roles, entities: Sequence | None = None,
                      range_of: tuple[str, str] | None = None, codes: DataFrame | None = None):
    """(frame, feature names): month, day of year, measures, their range and the entity code.

    Missing numbers take the column mean. All other columns stay on the row.
    """
    rows = filter_in(df, roles.entity, entities) if entities else df
    rows = add_calendar(rows, roles.date, ("Month", "DayOfYear"), labels=None)
    names = ["Month", "DayOfYear", *roles.measures]
    if range_of:
        rows = rows.withColumn("Range", value_range(*range_of))
        names.append("Range")
    if codes is not None:
        rows = encode_code(rows, roles.entity, codes, "EntityCode")
        names.append("EntityCode")
    rows = rows.withColumns({f"f_{n}": F.col(n).cast("double") for n in names})
    features = [f"f_{n}" for n in names]
    return impute(rows, features, "mean"), features


def rain_history(df: DataFrame, today: str, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Default rain history 0/1 columns from today's label; 0 when there is no label column."""
    value = (F.col(today) == "Yes").cast("int") if today in df.columns else F.lit(0)
    adds = {f"rain_day_{k}": F.coalesce(value, F.lit(0)) for k in horizons if f"rain_day_{k}" not in df.columns}
    return df.withColumns(adds)


def horizon_targets(df: DataFrame, roles: Roles, variables: Sequence[str],
                    horizons: Sequence[int] = HORIZONS) -> tuple[DataFrame, list[str], list[str]]:
    """(frame, value targets, label targets): values and the 0/1 label k rows later in the entity."""
    rows = df.withColumn("rain", yesno_to_int(roles.today)) if roles.today else df
    shifted_vars = [*variables, *(["rain"] if roles.today else [])]
    out = lead_targets(rows, roles.entity, roles.order(), shifted_vars, horizons)
    return (out, [f"{v}_day_{k}" for v in variables for k in horizons],
            [f"rain_day_{k}" for k in horizons] if roles.today else [])


def fit_horizons(df: DataFrame, features: Sequence[str], targets: Sequence[str], labels: Sequence[str],
                 C: float = 1.0, eps: float = 0.1, **kw) -> HorizonModels:
    """Fit every regressor in one job per step, and every label classifier in another.

    Targets without data (or labels with one class) get no model.
    """
    start = time.perf_counter()
    # both fits go over the same shifted rows several times
    rows = df.select(*features, *targets, *labels).persist(StorageLevel.MEMORY_AND_DISK)
    weights = fit_margin(rows, features, targets, "eps", C, eps, scaled=True, **kw)
    label_weights, platt = fit_classifier(rows, features, labels, C, **kw) if labels else (weights.limit(0), {})
    rows.unpersist()
    return HorizonModels(weights, label_weights, platt, time.perf_counter() - start)


def predict_wide(df: DataFrame, models: HorizonModels, keep: Sequence[str]) -> DataFrame:
    """One row per input row with every target's value, label targets as probabilities."""
    cols = [margin_column(m).alias(t) for t, m in weights_of(models.weights).items()]
    cols += [platt_column(margin_column(m), models.platt[t]).alias(t)
             for t, m in weights_of(models.label_weights).items()]
    return df.select(*keep, *cols)


def sequence_forecast(df: DataFrame, models: HorizonModels, keep: Sequence[str], variables: Sequence[str],
                      days: int = 3, longest: int = 3) -> DataFrame:
    """One row per input row and day ahead with each variable's value, rain probability and Yes/No.

    Days beyond the longest fitted horizon use the model of that horizon.
    """
    wide = predict_wide(df, models, keep)
    have = set(wide.columns)

    def at(name: str, k: int):
        target = f"{name}_day_{min(k, longest)}"
        return F.col(target) if target in have else F.lit(None).cast("double")

    steps = F.explode(F.array(*[
        F.struct(F.lit(k).alias("Day"), *[at(v, k).alias(v) for v in variables], at("rain", k).alias("rain_probability"))
        for k in range(1, days + 1)
    ]))
    return wide.select(*keep, steps.alias("s")).select(*keep, "s.*").withColumn("rain_forecast", rain_label("rain_probability"))


def scoring_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with exactly the fitted feature columns, absent ones as 0."""
    return conform(df, [*[c for c in df.columns if c not in features], *features])
