"""Synthetic rows and coherent day sequences drawn from history.

All randomness is a hash of (entity, day, variable, seed), so results do not
depend on how rows are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsledger.functions.scalars import normal, uniform
from obsledger.operators.clean import filter_month, filter_month_or_all
from obsledger.operators.stats import scalar_row
from obsledger.operators.timeline import diff_stats
from obsledger.roles import Roles

# Noise of a bootstrapped row and of a daily step, in standard deviations.
ROW_NOISE = 0.1
STEP_NOISE = 0.8


# Up to so many rows a group, Spark itself keeps only the first of each task before it shuffles them for a ranking.
RANKED = 1000
# Beyond, the smallest hashes are found within so many parts of an entity first.
PARTS = 64


def _pick(df: DataFrame, keys: Sequence[str], cols: Sequence[str], days: int, seed: int,
          by: Sequence[str] = ()) -> DataFrame:
    """One hashed row of history per (.., day): of the ``days`` rows with the smallest hashes, each day draws one.

    A large entity is never gathered, only its ``days`` rows, and the plan is the same for any number of days.
    """
    rows = df.select(*by, F.struct(F.xxhash64(*keys, F.lit(seed)).alias("h"), F.struct(*cols).alias("r")).alias("_s"),
                     *([F.pmod(F.xxhash64(*keys, F.lit("part")), F.lit(PARTS)).alias("_part")] if days > RANKED else []))
    for groups in ([[*by, "_part"]] if days > RANKED else []) + [list(by)]:
        place = F.row_number().over(W.partitionBy(*groups).orderBy("_s.h"))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= days)
    held = rows.groupBy(*by).agg(F.array_sort(F.collect_list("_s")).alias("_all"))
    draws = F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda day: F.struct(day.alias("day"), F.element_at(
        "_all", (F.floor(uniform(seed, *[F.col(c) for c in by], day, "draw") * F.size("_all")) + 1).cast("int"))["r"].alias("r")))
    return held.select(*by, F.explode(draws).alias("_x")).select(*by, "_x.day", "_x.r.*")


def _category_fill(df: DataFrame, keys: Sequence[str], categories: Sequence[str], days: int, seed: int) -> dict:
    """Per category observed values drawn by the smallest hashes over rows that have it, one for each day (in turn if fewer)."""
    out: dict = {}
    for c in categories:
        drawn = df.where(F.col(c).isNotNull()).select(F.xxhash64(*keys, F.lit(seed), F.lit(c)).alias("h"), F.col(c).alias("v")).orderBy("h", "v").limit(days)
        one = drawn.agg(F.transform(F.array_sort(F.collect_list(F.struct("h", "v"))), lambda p: p["v"]).alias(c))
        out |= scalar_row(one)
    return out


def synthetic_days(df: DataFrame, roles: Roles, n: int = 10, start: str = "2025-01-01", seed: int = 42) -> DataFrame:
    """``n`` rows from ``start`` on: history of the same month plus noise of 0.1 standard deviations.

    Missing categories take an observed value. Raises when the month has no rows.
    """
    month = int(start[5:7])
    pool = filter_month(df, roles.date, month, require=True)
    keys = [roles.entity, roles.date, *roles.key]
    carried = [roles.entity, *roles.measures, *roles.categoricals]
    stds = scalar_row(pool.agg(*[F.stddev_samp(m).alias(m) for m in roles.measures]))
    fills = _category_fill(df, keys, roles.categoricals, n, seed)
    rows = _pick(pool, keys, carried, n, seed)
    noisy = {m: (F.col(m) + normal(F.col("day"), m, seed) * stds[m] * ROW_NOISE) for m in roles.measures}
    filled = {c: F.coalesce(F.col(c), F.get(fills[c], F.when(F.size(fills[c]) > 0, F.col("day") % F.size(fills[c])))) for c in roles.categoricals}
    out = rows.withColumns({**noisy, **filled, roles.date: F.date_add(F.lit(start).cast("date"), F.col("day"))})
    return out.select(roles.entity, roles.date, *roles.measures, *roles.categoricals)


def coherent_sequences(df: DataFrame, roles: Roles, variables: Sequence[str], entities: Sequence | None = None,
                       start: str | None = None, length: int = 3, seed: int = 42, min_rows: int = 10) -> DataFrame:
    """``length`` days per entity: a bootstrapped day, then steps drawn from the entity's daily changes.

    value(t) = value(t-1) + N(mean change, 0.8 * std of changes) for ``variables``;
    other columns are drawn afresh each day. Today's label is yesterday's
    next-day label. History is the start month, or all rows of an entity with
    fewer than ``min_rows`` of them. Raises when no entity has rows.
    """
    rows = df.where(F.col(roles.entity).isin(*entities)) if entities else df
    first = F.lit(start).cast("date") if start else F.current_date()
    month = int(start[5:7]) if start else rows.sparkSession.range(1).select(F.month(F.current_date())).first()[0]
    pool = filter_month_or_all(rows, roles.entity, roles.date, month, min_rows)
    if pool.isEmpty():
        raise ValueError("no entity has any rows")
    keys = [roles.entity, roles.date, *roles.key]
    labels = [c for c in (roles.today, roles.label) if c and c in df.columns]
    others = [c for c in roles.categoricals if c not in labels]
    carried = [*roles.measures, *others, *labels]
    spread = pool.groupBy(roles.entity).agg(*[F.stddev_samp(m).alias(f"_sd_{m}") for m in roles.measures])
    steps = (
        diff_stats(pool, roles.entity, roles.order(), variables)
        .groupBy(roles.entity).agg(*[
            F.max(F.when((F.col("variable") == v) & (F.col("n_pairs") > 0), F.struct("mean_step", "std_step"))).alias(f"_step_{v}")
            for v in variables])
    )
    drawn = (_pick(pool, keys, carried, length, seed, by=[roles.entity])
             .join(spread, roles.entity).join(steps, roles.entity, "left"))
    noise = {m: F.col(m) + normal(F.col(roles.entity), F.col("day"), m, seed) * F.coalesce(F.col(f"_sd_{m}"), F.lit(0.0)) * ROW_NOISE
             for m in roles.measures}
    drawn = drawn.withColumns(noise)
    # at most ``length`` rows per entity
    upto = W.partitionBy(roles.entity).orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    walks = {}
    for v in variables:
        step = F.col(f"_step_{v}")
        change = F.when(F.col("day") == 0, F.col(v)).otherwise(
            step["mean_step"] + normal(F.col(roles.entity), F.col("day"), v, seed, "step") * step["std_step"] * STEP_NOISE)
        known = F.first(F.col(v)).over(upto).isNotNull()  # a walk from a missing day stays missing
        walks[v] = F.when(step.isNull(), F.col(v)).otherwise(F.when(known, F.sum(change).over(upto)))
    out = drawn.withColumns(walks).withColumn(roles.date, F.date_add(first, F.col("day")))
    if len(labels) == 2:
        before = F.lag(roles.label).over(W.partitionBy(roles.entity).orderBy("day"))
        out = out.withColumn(roles.today, F.coalesce(before, F.col(roles.today)))
    return out.select(roles.entity, roles.date, "day", *roles.measures, *others, *labels)


