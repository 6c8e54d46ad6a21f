"""Small statistics rows, exact quantiles and modes that hold at any size.

A statistic is a DataFrame of one row. Inside one operator it is applied as a
scalar subquery, so statistics and data stay in one plan without a join. A
*fitted* statistic (fill values, fences, scalers, model parameters) is read
once and applied as constants: chains of fits then never compute an earlier
fit again, and filters on the result can reach the scan.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.session import cut_lineage

# Distinct values one task may hold for Spark's own exact percentile.
MAX_DISTINCT = 1_000_000
# Rows of one value bracket the driver may read to finish an exact quantile.
MAX_ROWS = 10_000
BUCKETS = 4096
LARGEST = sys.float_info.max


def scalar_row(stats: DataFrame) -> dict[str, Column]:
    """Columns of a one-row frame as scalar columns usable in any other frame."""
    packed = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return {name: packed.getField(name) for name in stats.columns}


def _constant(value, kind: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_constant(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.array(*[_constant(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def fitted_row(stats: DataFrame) -> dict[str, Column]:
    """Columns of a fitted one-row frame as constants."""
    row = stats.first()
    return {f.name: _constant(row[f.name], f.dataType) for f in stats.schema.fields}


def _fits_one_task(df: DataFrame, cols: Sequence[str], by: Sequence[str], limit: int) -> bool:
    """True when no group has more than about ``limit`` distinct values in any column."""
    sizes = df.groupBy(*by).agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    top = sizes.agg(F.max(F.greatest(*cols) if len(cols) > 1 else F.col(cols[0]))).first()[0]
    return (top or 0) <= limit


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    max_distinct: int = MAX_DISTINCT,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per group, one array column per measure.

    Without groups the ranks are narrowed down by histograms over all tasks.
    With groups Spark's exact ``percentile`` is used after a count shows that no
    group has more than ``max_distinct`` values (it holds them in one task);
    otherwise the ranks of all groups are searched with joined histograms. NaN is missing, infinities are ordered, and
    a missing group key is a group.
    """
    cols, probs, by = list(cols), [float(p) for p in probs], list(by)
    df = _known(df, cols)
    if not by:
        return _global_quantiles(df, cols, probs, max_rows)
    if _fits_one_task(df, cols, by, max_distinct):
        wanted = F.array(*map(F.lit, probs))
        return df.groupBy(*by).agg(*[F.percentile(F.col(c).cast("double"), wanted).alias(c) for c in cols])
    found = _search_ranks(df, cols, probs, by, max_distinct)
    pick = [
        F.array(*[
            F.max(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value")))
            for p in probs
        ]).alias(c)
        for c in cols
    ]
    # groups without any value have missing quantiles
    empty = F.array(*[F.lit(None).cast("double") for _ in probs])
    every = null_safe_join(df.select(*by).distinct(), found.groupBy(*by).agg(*pick), by, "left")
    return every.select(*by, *[F.coalesce(c, empty).alias(c) for c in cols])


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where a missing key equals a missing key; the left side's keys stay."""
    names = {c: f"_right_{c}" for c in on}
    other = right.withColumnsRenamed(names)
    same = F.lit(True)
    for c, n in names.items():
        same = same & left[c].eqNullSafe(other[n])
    return left.join(other, same, how).drop(*names.values())


def _known(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN is a missing value."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols
                           if df.schema[c].dataType.typeName() in ("float", "double")})


def _global_quantiles(df: DataFrame, cols: list[str], probs: list[float], max_rows: int) -> DataFrame:
    """One row of quantile arrays, found with a few counting passes over the needed columns.

    Every wanted rank has a bracket of values. A pass counts the rows of each
    bracket in BUCKETS equal cells and keeps the cell holding the rank, until a
    bracket is a single value or holds at most ``max_rows`` rows, whose distinct
    values are then read. The driver sees cell counts and those values only.
    """
    x = {c: F.col(c).cast("double") for c in cols}
    span = df.agg(*[F.struct(F.count(c).alias("n"), F.min(x[c]).alias("lo"), F.max(x[c]).alias("hi")).alias(c)
                    for c in cols]).first()
    ends, brackets = {}, {}  # (column, rank) -> (lo, hi, rows below, rows inside)
    for c in cols:
        for p in probs:
            at = p * (span[c]["n"] - 1)
            ends[c, p] = (math.floor(at), math.ceil(at), at - math.floor(at))
            for rank in ends[c, p][:2]:
                if span[c]["n"]:
                    brackets[c, rank] = (span[c]["lo"], span[c]["hi"], 0, span[c]["n"])
    values = {}

    def tagged(found: list, extra) -> DataFrame:
        """Rows (bracket number, ..extra) for every bracket a value falls into."""
        tags = [F.when(x[c].between(lo, hi), F.struct(F.lit(i).alias("i"), *extra(x[c], lo, hi)))
                for i, (c, lo, hi) in enumerate(found)]
        return df.select(F.explode(F.array(*tags)).alias("t")).where(F.col("t").isNotNull()).select("t.*")

    while True:
        values.update({k: b[0] for k, b in brackets.items() if b[0] == b[1]})
        wide = {(k[0], *b[:2]) for k, b in brackets.items() if k not in values and b[3] > max_rows}
        if not wide:
            break
        found = sorted(wide)

        def cell(v, lo, hi):
            return [_cell(v, F.lit(lo), F.lit(hi)).alias("cell"), v.alias("v")]

        cells: dict[int, list] = {}
        counted = tagged(found, cell).groupBy("i", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for r in counted.collect():  # at most BUCKETS rows per bracket
            cells.setdefault(r["i"], []).append(r)
        for (c, rank), (lo, hi, below, _) in list(brackets.items()):
            if (c, lo, hi) not in wide:
                continue
            for r in sorted(cells[found.index((c, lo, hi))], key=lambda r: r["cell"]):
                if rank < below + r["n"]:
                    brackets[c, rank] = (r["lo"], r["hi"], below, r["n"])
                    break
                below += r["n"]
    rest = {k: b for k, b in brackets.items() if k not in values}
    if rest:
        found = sorted({(k[0], *b[:2]) for k, b in rest.items()})
        seen: dict[int, list] = {}
        for r in (tagged(found, lambda v, lo, hi: [v.alias("v")]).groupBy("i", "v")
                  .agg(F.count(F.lit(1)).alias("n")).collect()):  # at most max_rows rows per bracket
            seen.setdefault(r["i"], []).append((r["v"], r["n"]))
        for (c, rank), (lo, hi, below, _) in rest.items():
            for v, n in sorted(seen[found.index((c, lo, hi))]):
                below += n
                if rank < below:
                    values[c, rank] = v
                    break

    def value(c: str, p: float):
        if not span[c]["n"]:
            return F.lit(None).cast("double")
        first, last, share = ends[c, p]
        a, b = values[c, first], values[c, last]
        return F.lit(a if a == b or not share else a + (b - a) * share)

    return df.sparkSession.range(1).select(*[F.array(*[value(c, p) for p in probs]).alias(c) for c in cols])


def _cell(v: Column, lo: Column, hi: Column) -> Column:
    """Cell of a value between lo and hi; the ends have cells of their own, so a bracket always shrinks."""
    low, high = F.greatest(lo, F.lit(-LARGEST)), F.least(hi, F.lit(LARGEST))
    share = F.coalesce(F.try_divide(v / 2 - low / 2, high / 2 - low / 2), F.lit(0.0))
    inner = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    return F.when(v == hi, BUCKETS).when(v == lo, -1).otherwise(inner)


def _search_ranks(df, cols, probs, by, limit) -> DataFrame:
    """Long rows (by.., column, prob, value) by repeated histograms around the wanted ranks."""
    long = (
        df.select(*by, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols
        ])).alias("cv"))
        .select(*by, "cv.column", "cv.v")
        .where(F.col("v").isNotNull())
    )
    group = [*by, "column"]
    ranks = F.explode(F.array(*map(F.lit, probs))).alias("prob")
    span = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    position = F.col("prob") * (F.col("n") - 1)
    targets = (
        span.select(*group, "n", "lo", "hi", ranks)
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array_distinct(F.array(
            F.floor("position"), F.ceil("position")))))
        .withColumn("below", F.lit(0).cast("long"))
        .withColumn("inside", F.col("n"))
    )
    search = [*group, "prob", "rank"]
    brackets = cut_lineage(targets.select(*search, "position", "lo", "hi", "below", "inside"))
    while True:
        open_ = brackets.where((F.col("inside") > limit) & (F.col("lo") < F.col("hi")))
        if open_.isEmpty():
            break
        hits = null_safe_join(long, open_, group).where(F.col("v").between(F.col("lo"), F.col("hi")))
        cell = _cell(F.col("v"), F.col("lo"), F.col("hi"))
        hist = hits.groupBy(*search, "position", "below", cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        # at most BUCKETS rows per searched rank
        upto = W.partitionBy(*search).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        narrowed = (
            hist.withColumn("below", F.col("below") + F.coalesce(F.sum("inside").over(upto), F.lit(0)))
            .where((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("inside")))
            .select(*search, "position", "lo", "hi", "below", "inside")
        )
        done = brackets.where((F.col("inside") <= limit) | (F.col("lo") >= F.col("hi")))
        brackets = cut_lineage(done.unionByName(narrowed))
    hits = null_safe_join(long, brackets, group).where(F.col("v").between(F.col("lo"), F.col("hi")))
    seen = hits.groupBy(*search, "position", "below", "v").agg(F.count(F.lit(1)).alias("c"))
    # bounded by ``limit`` distinct values per searched rank
    upto = W.partitionBy(*search).orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    at_rank = (
        seen.withColumn("end", F.col("below") + F.sum("c").over(upto))
        .where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("c")))
    )
    pair = at_rank.groupBy(*group, "prob").agg(
        F.min_by("v", "rank").alias("a"), F.max_by("v", "rank").alias("b"),
        F.max(F.col("position") - F.floor("position")).alias("frac"))
    return pair.select(*group, "prob", (F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")).alias("value"))


def medians(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """One row with the exact median of every column."""
    return quantiles(df, cols, [0.5], **kw).select(*[F.col(c)[0].alias(c) for c in cols])


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the most frequent value of every column; a tie goes to the smallest value.

    Values are counted per (column, value) over all tasks first, so a column
    with many distinct texts never sits in one task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])
    counts = (
        df.select(F.explode(pairs).alias("cv")).select("cv.column", "cv.v")
        .where(F.col("v").isNotNull())
        .groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.struct((-F.col("n")).alias("n"), F.col("v"))
    return counts.agg(*[F.min(F.when(F.col("column") == c, best)).getField("v").alias(c) for c in cols])
