"""Projection, filters, schema conforming, imputation, outliers, calendar columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.scalars import calendar_part, season, uniform
from obsledger.operators.stats import fitted_row, medians, modes, quantiles
from obsledger.operators.timeline import value_ranks
from obsledger.session import cut_lineage

# Buckets that random fills are joined by, at least.
FILL_BUCKETS = 4096


# ---- projection and filters ----------------------------------------------------

def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def dedup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    first = [i for i, c in enumerate(df.columns) if c not in df.columns[:i]]
    names = [df.columns[i] for i in first]
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(*[f"c{i}" for i in first]).toDF(*names)


def filter_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(*values))


def filter_eq(df: DataFrame, **equals) -> DataFrame:
    for name, value in equals.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def filter_month(df: DataFrame, date: str, month: int, require: bool = False) -> DataFrame:
    """Rows of one calendar month; ``require`` raises when there are none."""
    out = df.where(F.month(date) == month)
    if require and out.isEmpty():
        raise ValueError(f"no rows for month {month}")
    return out


def filter_month_or_all(df: DataFrame, entity: str, date: str, month: int, min_rows: int = 10) -> DataFrame:
    """Rows of one month per entity; entities with fewer than ``min_rows`` of them keep all rows."""
    enough = (
        df.groupBy(entity).agg(F.count_if(F.month(date) == month).alias("in_month"))
        .select(entity, (F.col("in_month") >= min_rows).alias("enough"))
    )
    return df.join(enough, entity).where(~F.col("enough") | (F.month(date) == month)).drop("enough")


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def training_rows(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Rows with a target and all features."""
    return df.dropna(subset=[target]).dropna(subset=list(features))


def training_row_report(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Rows dropped for a missing target, then for a missing feature, and rows kept."""
    has_target = F.col(target).isNotNull()
    complete = F.lit(True)
    for f in features:
        complete = complete & F.col(f).isNotNull()
    return df.agg(
        F.count_if(~has_target).alias("dropped_target"),
        F.count_if(has_target & ~complete).alias("dropped_features"),
        F.count_if(has_target & complete).alias("kept"))


def conform(df: DataFrame, expected: Sequence[str], fill: float = 0) -> DataFrame:
    """Exactly the expected columns in order; absent ones hold ``fill``."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in expected])


def encode_code(df: DataFrame, col: str, dim: DataFrame, code: str, default: int = 0) -> DataFrame:
    """Integer code of a category from a dimension (name, code); unknown names get ``default``."""
    dim = dim.select(F.col("name").alias(col), F.col("code").alias(code))
    return df.join(dim, col, "left").withColumn(code, F.coalesce(F.col(code), F.lit(default)))


def categories(df: DataFrame, col: str, limit: int = 1000) -> list:
    """Sorted categories for wide one-hot columns; refuses more than ``limit`` columns (``one_hot_index`` has no limit)."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} categories: use one_hot_index or name the values")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, col: str, values: Sequence | None = None, drop_first: bool = False) -> DataFrame:
    """Replace ``col`` by 0/1 columns ``<col>_<value>``, values sorted."""
    values = sorted(values) if values is not None else categories(df, col)
    hot = [F.coalesce(F.col(col) == v, F.lit(False)).cast("int").alias(f"{col}_{v}")
           for v in values[1 if drop_first else 0:]]
    return df.select(*[c for c in df.columns if c != col], *hot)


def one_hot_index(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Sparse one-hot form for any number of categories: ``out`` is the position of the hot column, from 0.

    Positions follow the sorted categories and are numbered in sorted ranges
    over all tasks. A missing category has no hot column.
    """
    out = out or f"{col}_index"
    places = value_ranks(df.select(col).distinct(), col, "_place", desc=False).select(
        F.col(col).alias("_value"), (F.col("_place") - 1).alias("_place"))
    return df.join(places, F.col(col) == F.col("_value"), "left").select(
        *[c for c in df.columns if c != out], F.col("_place").alias(out))


# ---- imputation ------------------------------------------------------------------

def fit_imputer(df: DataFrame, cols: Sequence[str], strategy: str = "median") -> DataFrame:
    """One row of fill values: median, mode, mean or zero per column."""
    if strategy == "median":
        return medians(df, cols)
    if strategy == "mode":
        return modes(df, cols)
    if strategy == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in cols])
    if strategy == "zero":
        return df.sparkSession.range(1).select(*[F.lit(0.0).alias(c) for c in cols])
    raise ValueError(f"unknown strategy {strategy}")


def apply_imputer(df: DataFrame, fills: DataFrame, fallback: str | float | None = None) -> DataFrame:
    """Put the fill value, then ``fallback``, where a column is missing."""
    fill = fitted_row(fills)

    def filled(c: str) -> Column:
        extra = [] if fallback is None else [F.lit(fallback)]
        return F.coalesce(F.col(c), fill[c], *extra).alias(c)

    return df.select(*[filled(c) if c in fill else F.col(c) for c in df.columns])


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "median",
           fit_on: DataFrame | None = None, fallback=None) -> DataFrame:
    """Fit on ``fit_on`` (default: the same rows) and fill ``cols``."""
    if strategy == "zero":
        return df.fillna(0, subset=list(cols))
    return apply_imputer(df, fit_imputer(fit_on if fit_on is not None else df, cols, strategy), fallback)


def impute_coerced_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Read every column as a number, drop the ones with no number at all, fill the rest with the mean."""
    from obsledger.functions.scalars import lenient_double

    numbers = df.select(*[lenient_double(c, None).alias(c) if c in cols else F.col(c) for c in df.columns])
    known = numbers.agg(*[F.count(c).alias(c) for c in cols]).first()
    empty = [c for c in cols if known[c] == 0]
    return impute(numbers.drop(*empty), [c for c in cols if c not in empty], "mean")


def impute_random(df: DataFrame, col: str, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Fill a missing category with an observed one, drawn by its frequency.

    A hash of the row key draws a position among the known rows; the category
    whose sorted rows cover it is taken. Positions are cut into at least
    ``FILL_BUCKETS`` buckets and as many as there are categories, so the join
    spreads whatever their number. Without any known row nothing is filled.
    """
    known = df.where(F.col(col).isNotNull())
    ranges = cut_lineage(value_ranks(known, col, "first", desc=False))
    size = ranges.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("values")).first()
    if not size["values"]:
        return df
    u = uniform(*[F.col(k) for k in key], seed, col)
    width = max(1, size["total"] // max(size["values"], FILL_BUCKETS))
    low = F.col("first") - 1
    spans = ranges.select(F.col(col).alias("_v"), low.alias("_lo"), (low + F.col("n")).alias("_hi")).withColumn(
        "_b", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor((F.col("_hi") - 1) / width))))
    gaps = (df.where(F.col(col).isNull()).withColumn("_at", F.floor(u * size["total"]))
              .withColumn("_b", F.floor(F.col("_at") / width)))
    hit = (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi"))
    filled = gaps.join(spans, "_b").where(hit).withColumn(col, F.col("_v")).select(*df.columns)
    return known.unionByName(filled)


# ---- outliers --------------------------------------------------------------------

def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """One row with a struct (q1, q3, lower, upper) per column."""
    q = quantiles(df, cols, [0.25, 0.75])

    def fence(c: str) -> Column:
        q1, q3 = F.col(c)[0], F.col(c)[1]
        spread = q3 - q1
        return F.struct(q1.alias("q1"), q3.alias("q3"), (q1 - spread * k).alias("lower"),
                        (q3 + spread * k).alias("upper")).alias(c)

    return q.select(*[fence(c) for c in cols])


def outside(col: str, fence: Column, two_sided: bool = True) -> Column:
    """1 when the value lies outside its fences, 0 otherwise and when missing."""
    beyond = F.col(col) > fence["upper"]
    if two_sided:
        beyond = beyond | (F.col(col) < fence["lower"])
    return F.coalesce(beyond, F.lit(False)).cast("int")


def flag_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, two_sided: bool = True) -> DataFrame:
    """Add ``<col>_Outlier`` 0/1 columns."""
    fence = fitted_row(iqr_bounds(df, cols, k))
    return df.select("*", *[outside(c, fence[c], two_sided).alias(f"{c}_Outlier") for c in cols])


def clip_upper(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Lower values above the upper fence to the fence; the lower side stays."""
    fence = fitted_row(iqr_bounds(df, cols, k))
    clipped = {c: F.when(F.col(c) > fence[c]["upper"], fence[c]["upper"]).otherwise(F.col(c)) for c in cols}
    return df.select(*[clipped[c].alias(c) if c in clipped else F.col(c) for c in df.columns])


def outlier_counts(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Rows outside the fences per column."""
    fence = fitted_row(iqr_bounds(df, cols, k))
    wide = df.agg(*[F.sum(outside(c, fence[c])).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_outliers")) for c in cols])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def extreme_rate(df: DataFrame, entity: str, col: str, k: float = 1.5) -> DataFrame:
    """Rows, outliers and outlier share per entity."""
    fence = fitted_row(iqr_bounds(df, [col], k))
    return (df.groupBy(entity)
              .agg(F.count(F.lit(1)).alias("n"), F.sum(outside(col, fence[col])).alias("n_extreme"),
                   F.avg(outside(col, fence[col])).alias("extreme_rate")))


# ---- calendar --------------------------------------------------------------------

CALENDAR_COLUMNS = {"Year": "year", "Month": "month", "Day": "day", "DayOfWeek": "day_of_week",
                    "Quarter": "quarter", "DayOfYear": "day_of_year"}


def add_calendar(df: DataFrame, date: str, parts: Sequence[str] = ("Year", "Month", "Day", "DayOfWeek", "Quarter"),
                 labels: str | None = "es") -> DataFrame:
    """Add calendar columns and, when ``labels`` is given, the season."""
    cols = [calendar_part(date, CALENDAR_COLUMNS[p]).alias(p) for p in parts]
    if labels:
        cols.append(season(F.month(date), labels).alias("Season"))
    return df.select("*", *cols)


def default_calendar(df: DataFrame, date: str = "Date", month: int = 6, day_of_year: int = 150) -> DataFrame:
    """Month and DayOfYear from the date, or fixed defaults when there is no date column."""
    have = date in df.columns
    adds = {}
    if "Month" not in df.columns:
        adds["Month"] = F.month(date) if have else F.lit(month)
    if "DayOfYear" not in df.columns:
        adds["DayOfYear"] = F.dayofyear(date) if have else F.lit(day_of_year)
    return df.withColumns(adds)
