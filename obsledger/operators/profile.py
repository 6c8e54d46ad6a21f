"""Profiling: missing counts, duplicates, summaries, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.operators.stats import fitted_row, null_safe_join, quantiles, scalar_row


def _tall(wide: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One-row frame of struct columns -> one row per column."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(c)[f].alias(f) for f in fields]) for c in cols
    ])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the numeric, text or date columns."""
    kinds = {"numeric": T.NumericType, "text": T.StringType,
             "date": (T.DateType, T.TimestampType, T.TimestampNTZType)}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, only columns that have any."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("n_null")).alias(c) for c in cols])
    return _tall(wide, cols, ["n_null"]).where("n_null > 0")


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Valid values per column: count, total, percent."""
    total = F.count(F.lit(1))
    wide = df.agg(*[
        F.struct(F.count(c).alias("n_valid"), total.alias("n_total"),
                 F.try_divide(F.count(c) * 100.0, total).alias("pct")).alias(c)
        for c in cols
    ])
    return _tall(wide, cols, ["n_valid", "n_total", "pct"])


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_dup"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column."""
    q = fitted_row(quantiles(df, cols, [0.25, 0.5, 0.75]))
    wide = df.agg(*[
        F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
        for c in cols
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c)["count"].alias("count"), F.col(c)["mean"].alias("mean"),
                 F.col(c)["std"].alias("std"), F.col(c)["min"].alias("min"), q[c][0].alias("p25"),
                 q[c][1].alias("p50"), q[c][2].alias("p75"), F.col(c)["max"].alias("max"))
        for c in cols
    ])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def iqr_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """q1, median, q3 and their spread per column."""
    q = quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c)[0].alias("q1"), F.col(c)[1].alias("median"),
                 F.col(c)[2].alias("q3"), (F.col(c)[2] - F.col(c)[0]).alias("iqr"))
        for c in cols
    ])
    return q.select(F.explode(rows).alias("r")).select("r.*")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum; the maximum falls in the last bin."""
    span = scalar_row(df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")))
    width = (span["hi"] - span["lo"]) / bins
    where = F.least(F.coalesce(F.floor(F.try_divide(F.col(col) - span["lo"], width)), F.lit(0)), F.lit(bins - 1))
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(where.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (span["lo"] + F.col("bin") * width).alias("lo"),
                (span["lo"] + (F.col("bin") + 1) * width).alias("hi"), "n")
    )


def histograms(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """(column, bin, lo, hi, n) of equal-width bins for all columns in two scans: one for the ends, one for the counts.

    Missing values and NaN are left out; a column without values has no bins, a constant one has all its rows in bin 0.
    """
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    ends = df.agg(*[F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias(f"{i}") for i, v in enumerate(values.values())]).first()
    cells = []
    for i, (c, v) in enumerate(values.items()):
        lo, hi = ends[i]
        if lo is not None:
            at = F.floor((v - lo) / ((hi - lo) / bins)).cast("int") if hi > lo else F.when(v.isNotNull(), 0)
            cells.append(F.struct(F.lit(c).alias("column"), F.when(v.isNotNull(), F.least(at, F.lit(bins - 1))).alias("bin"),
                                  F.lit(float(lo)).alias("from"), F.lit((hi - lo) / bins).alias("width")))
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, n long")
    counted = (df.select(F.explode(F.array(*cells)).alias("x")).select("x.*").where(F.col("bin").isNotNull())
               .groupBy("column", "bin", "from", "width").agg(F.count(F.lit(1)).alias("n")))
    return counted.select("column", "bin", (F.col("from") + F.col("bin") * F.col("width")).alias("lo"),
                          (F.col("from") + (F.col("bin") + 1) * F.col("width")).alias("hi"), "n")


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are present; one pass."""
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}").alias("r")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"{i}").alias("r")))
    return wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def quantiles_by(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float]) -> DataFrame:
    """Count and quantiles of a measure per category."""
    q = quantiles(df, [col], probs, by=by)
    n = df.groupBy(*by).agg(F.count(col).alias("n"))
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    return null_safe_join(n, q, list(by)).select(*by, "n", *[F.col(col)[i].alias(x) for i, x in enumerate(names)])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows and percent of all rows per value."""
    total = scalar_row(df.agg(F.count(F.lit(1)).alias("t")))["t"]
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("pct", F.col("n") * 100.0 / total))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and shares of a 0/1 label."""
    n = F.count(label)
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos"),
        F.try_divide(F.count_if(F.col(label) == 0) * 1.0, n).alias("share_neg"),
        F.try_divide(F.count_if(F.col(label) == 1) * 1.0, n).alias("share_pos"))


def shape(df: DataFrame) -> DataFrame:
    """Row and column count as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))
