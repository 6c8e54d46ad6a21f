"""Grouped means, rates, contrasts and risk scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.operators.stats import fitted_row, medians, null_safe_join, quantiles, scalar_row
from obsledger.operators.timeline import rank_by
from obsledger.session import cut_lineage


def mean_by(df: DataFrame, by: Sequence[str] | str, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """Mean of each column per group, optionally over the rows of ``where`` only."""
    by = [by] if isinstance(by, str) else list(by)
    if where is not None:
        df = df.where(where)
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def risk_index(df: DataFrame, entity: str, prediction: str, run_id: str, out: str = "city") -> DataFrame:
    """Mean predicted label per entity, stamped with the run."""
    return (df.groupBy(F.col(entity).alias(out)).agg(F.avg(prediction).alias("climate_risk_index"))
              .select(F.lit(run_id).alias("run_id"), out, "climate_risk_index"))


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Mean of all measures per cluster."""
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols])


def global_stats(df: DataFrame, cols: Sequence[str], date: str | None = None,
                 probs: Sequence[float] = (0.25, 0.75)) -> DataFrame:
    """One row: mean, sample std, median and quantiles of each column, and the latest date."""
    med, qs = fitted_row(medians(df, cols)), fitted_row(quantiles(df, cols, probs))
    base = df.agg(*[a for c in cols for a in (F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}"))],
                  *([F.max(date).alias("max_date")] if date else []))
    return base.select("*", *[med[c].alias(f"median_{c}") for c in cols],
                       *[qs[c][i].alias(f"q{int(round(p * 100))}_{c}") for c in cols for i, p in enumerate(probs)])


def group_share(df: DataFrame, by: str) -> DataFrame:
    """Rows per group and percent of all rows."""
    total = scalar_row(df.agg(F.count(F.lit(1)).alias("t")))["t"]
    return (df.groupBy(by).agg(F.count(F.lit(1)).alias("size"))
              .withColumn("percentage", F.col("size") * 100.0 / total))


def rate_by_cluster(df: DataFrame, cluster: str, flag: str) -> DataFrame:
    """Flag rate in percent per cluster, the mean of the rates, and whether the cluster lies above it."""
    rates = df.groupBy(cluster).agg((F.avg(flag) * 100).alias("rate_pct"))
    mean = scalar_row(rates.agg(F.avg("rate_pct").alias("m")))["m"]
    return rates.select(cluster, "rate_pct", mean.alias("mean_rate_pct"),
                        (F.col("rate_pct") > mean).cast("int").alias("is_high"))


def contrast(df: DataFrame, flag: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each column on flagged and other rows, their difference and percent difference."""
    yes, no = F.col(flag) == 1, F.col(flag) == 0
    wide = df.agg(*[F.struct(F.avg(F.when(yes, F.col(c))).alias("flagged_mean"),
                             F.avg(F.when(no, F.col(c))).alias("normal_mean")).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["flagged_mean"].alias("flagged_mean"),
                              F.col(c)["normal_mean"].alias("normal_mean")) for c in cols])
    diff = F.col("flagged_mean") - F.col("normal_mean")
    return (wide.select(F.explode(rows).alias("r")).select("r.*")
            .withColumn("difference", diff)
            .withColumn("pct", F.try_divide(F.abs(diff), F.col("normal_mean")) * 100)
            .withColumn("direction", F.when(diff > 0, "mayor").otherwise("menor")))


def distinct_count(df: DataFrame, col: str, out: str = "n_distinct") -> DataFrame:
    return df.agg(F.count_distinct(col).alias(out))


def threshold_days(df: DataFrame, entity: str, rules: Mapping[str, Column], spread: Sequence[str]) -> DataFrame:
    """Days meeting each rule, and mean and sample std of measures, per entity."""
    return df.groupBy(entity).agg(
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
        *[a for c in spread for a in (F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}"))])


def composite_risk(df: DataFrame, entity: str, weights: Mapping[str, float], invert: Sequence[str] = (),
                   by: str | None = None) -> DataFrame:
    """Weighted score of min-max scaled entity means, its rank and the factor adding most.

    ``invert`` measures count the other way round (low humidity is risk).
    ``by`` scores and ranks inside each season or period.
    """
    keys = [entity] + ([by] if by else [])
    # the rows are read once; everything after works on one row per entity
    means = cut_lineage(df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in weights]))
    spans = means.groupBy(*([by] if by else [])).agg(
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f"_{c}") for c in weights])
    if by:
        wide = null_safe_join(means, spans, [by])
        span = {c: F.col(f"_{c}") for c in weights}
    else:
        wide, span = means, {c: v for c, v in zip(weights, scalar_row(spans).values())}

    def part(c: str) -> Column:
        scaled = F.coalesce(F.try_divide(F.col(c) - span[c]["lo"], span[c]["hi"] - span[c]["lo"]), F.lit(0.0))
        return ((1 - scaled) if c in invert else scaled) * F.lit(float(weights[c]))

    parts = wide.select(*keys, *[part(c).alias(c) for c in weights])
    total = sum((F.col(c) for c in weights), F.lit(0.0))
    best = F.array_max(F.array(*[F.struct(F.col(c).alias("v"), F.lit(-i).alias("o"), F.lit(c).alias("name"))
                                 for i, c in enumerate(weights)]))
    scored = parts.select(*keys, total.alias("score"), best["name"].alias("top_factor"))
    return rank_by(scored, "score", by=by)
