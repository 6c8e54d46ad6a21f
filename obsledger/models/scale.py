"""Standardising to mean 0 and population standard deviation 1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.operators.stats import fitted_row


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with a struct (mean, std) per column; a constant column gets std 1."""
    def one(c):
        std = F.stddev_pop(c)
        return F.struct(F.avg(c).alias("mean"),
                        F.when(std > 0, std).otherwise(F.lit(1.0)).alias("std")).alias(c)
    return df.agg(*[one(c) for c in cols])


def scale(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Standardise the fitted columns in place, every other column stays."""
    s = fitted_row(fitted)
    return df.select(*[
        ((F.col(c) - s[c]["mean"]) / s[c]["std"]).alias(c) if c in s else F.col(c) for c in df.columns])


def scaler_values(fitted: DataFrame) -> dict[str, tuple[float, float]]:
    """Scaler as plain numbers, for storing beside model weights."""
    row = fitted.first()
    return {c: (row[c]["mean"] or 0.0, row[c]["std"]) for c in fitted.columns}
