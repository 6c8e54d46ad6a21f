"""Row shifts, next-day labels, splits and ranks that stay spread over the cluster.

One entity may hold a large part of all rows, so no window runs over a whole
entity: rows are cut into blocks of checked size, the window runs per (entity,
block) and only the few rows at block edges are looked at across blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsledger.functions.scalars import uniform
from obsledger.operators.stats import null_safe_join
from obsledger.session import cut_lineage

BLOCK_DAYS = 32
# Rows of one entity a single task may order.
BLOCK_ROWS = 2_000_000


def _block(date: str, days: int) -> Column:
    return F.floor(F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date")) / F.lit(days))


def ranged(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Spread rows in sorted ranges of ``cols`` over the tasks and keep the range number.

    The ranges are drawn from a sample of all rows, so they are even for any
    spread of values. The numbered rows are written to the shared folder: a
    later recomputation can not draw other ranges.
    """
    return cut_lineage(df.repartitionByRange(*cols).withColumn(out, F.spark_partition_id()))


def in_blocks(df: DataFrame, entity: str, order: Sequence[str], block_days: int | None = None,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``_block``: consecutive pieces of each entity, none larger than a task can order.

    Pieces are calendar blocks of 32 days, or of one day when an entity is too
    dense for that, or sorted ranges of rows when even its days are.
    """
    for days in [block_days] if block_days else (BLOCK_DAYS, 1):
        blocked = df.withColumn("_block", _block(order[0], days))
        if block_days:
            return blocked
        largest = blocked.groupBy(entity, "_block").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (largest or 0) <= block_rows:
            return blocked
    return ranged(df, [entity, *order], "_block")


def shifted(df: DataFrame, entity: str, order: Sequence[str], shifts: Mapping[str, tuple[str, int]],
            block_days: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add columns holding the value ``k`` rows later (k > 0) or earlier (k < 0) in the entity.

    ``order`` starts with the date and ends with a tie-breaker where dates
    repeat. ``shifts`` maps the new column to (source column, k).
    """
    ahead = max([k for _, k in shifts.values() if k > 0], default=0)
    behind = max([-k for _, k in shifts.values() if k < 0], default=0)
    reach = ahead + behind

    def moved(window):
        return {
            name: F.lead(col, k).over(window) if k > 0 else F.lag(col, -k).over(window)
            for name, (col, k) in shifts.items()
        }

    in_block = W.partitionBy(entity, "_block").orderBy(*order)
    rows = in_blocks(df, entity, order, block_days, block_rows).withColumns({
        **moved(in_block), "_first": F.row_number().over(in_block),
        # missing on the last rows of a block
        "_more": F.lead(F.lit(1), ahead).over(in_block), "_far": F.lead(F.lit(1), reach).over(in_block)})
    unsettled = F.col("_more").isNull() | (F.col("_first") <= behind)
    settled = rows.where(~unsettled)
    # at most 2 * reach rows per (entity, block), and few blocks per entity
    edges = rows.where((F.col("_first") <= reach) | F.col("_far").isNull())
    across = W.partitionBy(entity).orderBy(*order)
    # dealt out evenly: a union whose sides both claim the entity's partitioning lets later plans skip an exchange they need
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    repaired = edges.withColumns(moved(across)).where(unsettled).repartition(parts)
    return settled.unionByName(repaired).drop("_block", "_first", "_more", "_far")


def lead_targets(df: DataFrame, entity: str, order: Sequence[str], variables: Sequence[str],
                 horizons: Sequence[int] = (1, 2, 3), block_days: int | None = None) -> DataFrame:
    """Add ``<variable>_day_<k>``: the value k rows later in the entity, missing at its end."""
    shifts = {f"{v}_day_{k}": (v, k) for v in variables for k in horizons}
    return shifted(df, entity, order, shifts, block_days)


def diff_stats(df: DataFrame, entity: str, order: Sequence[str], variables: Sequence[str],
               zero_std: float = 0.5, block_days: int | None = None, extra_by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of consecutive differences per entity and variable.

    Only pairs with both values count; a std of 0 becomes ``zero_std``.
    """
    prev = shifted(df, entity, order, {f"_prev_{v}": (v, -1) for v in variables}, block_days)
    by = [entity, *extra_by]
    steps = F.explode(F.array(*[
        F.struct(F.lit(v).alias("variable"), (F.col(v) - F.col(f"_prev_{v}")).alias("step")) for v in variables
    ]))
    std = F.stddev_pop("step")
    return (
        prev.select(*by, steps.alias("s")).select(*by, "s.variable", "s.step")
        .groupBy(*by, "variable")
        .agg(F.count("step").alias("n_pairs"), F.avg("step").alias("mean_step"),
             F.when(std == 0, F.lit(zero_std)).otherwise(std).alias("std_step"))
    )


def carry_label(df: DataFrame, entity: str, order: Sequence[str], source: str, target: str,
                block_days: int | None = None) -> DataFrame:
    """Set ``target`` to the previous row's ``source``; the first row of an entity keeps its own."""
    out = shifted(df, entity, order, {"_carried": (source, -1)}, block_days)
    return out.withColumn(target, F.coalesce(F.col("_carried"), F.col(target))).drop("_carried")


def next_day_label(df: DataFrame, entity: str, date: str, label: str, out: str,
                   gap: int = 1, repeats: str = "any") -> DataFrame:
    """Label of the same entity ``gap`` days later, missing when that day is absent.

    ``repeats="any"`` reduces repeated days to their largest label first, so a
    row never multiplies. ``repeats="each"`` gives one row per distinct next-day
    label with its number of copies in ``<out>_copies``.
    """
    source = df.select(entity, F.date_sub(F.col(date).cast("date"), gap).alias("_d"), F.col(label).alias(out))
    if repeats == "any":
        later = source.groupBy(entity, "_d").agg(F.max(out).alias(out))
    else:
        later = source.groupBy(entity, "_d", out).agg(F.count(F.lit(1)).alias(f"{out}_copies"))
    return df.withColumn("_d", F.col(date).cast("date")).join(later, [entity, "_d"], "left").drop("_d")


def first_n(df: DataFrame, by: str, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows per group; Spark keeps only n rows per group before the shuffle."""
    w = W.partitionBy(by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_k(df: DataFrame, by: Sequence[str], name: str, value: str, k: int = 3, by_abs: bool = True) -> DataFrame:
    """The k largest (absolute) values per group with their rank; ties by name."""
    size = F.abs(value) if by_abs else F.col(value)
    w = W.partitionBy(*by).orderBy(size.desc(), F.col(name))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def cumulative(df: DataFrame, order: str, col: str, out: str) -> DataFrame:
    """Running sum over a short frame (components, categories, models)."""
    return df.withColumn(out, F.sum(col).over(W.orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def value_ranks(df: DataFrame, col: str, out: str = "rank", desc: bool = True, by: str | None = None) -> DataFrame:
    """(.., value, rank, n) of every distinct value, without one global sort task.

    Distinct values are counted and spread in sorted ranges; a value's rank is
    the rows of the better ranges plus the better rows of its own range.
    """
    keys = [by] if by else []
    counts = (df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("_v"))
                .agg(F.count(F.lit(1)).alias("_c")))
    spread = ranged(counts, [*keys, "_v"], "_b").withColumn("_b", -F.col("_b") if desc else F.col("_b"))
    better = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    # one row per range
    ahead = (spread.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
                   .select(*keys, "_b", F.coalesce(F.sum("_bc").over(better), F.lit(0)).alias("_ahead")))
    inside = (W.partitionBy(*keys, "_b").orderBy(F.desc("_v") if desc else F.asc("_v"))
               .rowsBetween(W.unboundedPreceding, -1))
    return (
        null_safe_join(spread.withColumn("_in", F.coalesce(F.sum("_c").over(inside), F.lit(0))), ahead, [*keys, "_b"])
        .select(*keys, F.col("_v").alias(col), (F.col("_ahead") + F.col("_in") + 1).alias(out), F.col("_c").alias("n"))
    )


def rank_by(df: DataFrame, col: str, out: str = "rank", desc: bool = True, by: str | None = None) -> DataFrame:
    """Add the competition rank over all rows (or inside ``by``); missing values get no rank."""
    keys = [by] if by else []
    ranked = value_ranks(df, col, out, desc, by).drop("n")
    # a missing value meets no rank, a missing group is a group
    return null_safe_join(df, ranked, [*keys, col], "left").select(*df.columns, out)


def sort_limit(df: DataFrame, order: Sequence[str | Column], n: int | None = None) -> DataFrame:
    out = df.orderBy(*order)
    return out if n is None else out.limit(n)


# ---- splits ----------------------------------------------------------------------

def hash_split(df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42):
    """(train, test) by a hash of the row key: the same rows on any partition layout."""
    u = uniform(*[F.col(k) for k in key], seed)
    return df.where(u >= test_size), df.where(u < test_size)


def sample_rows(df: DataFrame, key: Sequence[str], ratio: float = 0.3, seed: int = 42) -> DataFrame:
    """A hashed share ``ratio`` of the rows, at every size.

    This is the opt-in training sample; fits run on all rows by default.
    """
    return df.where(uniform(*[F.col(k) for k in key], seed, "cap") < ratio)


def split_point(df: DataFrame, entity: str, date: str, key: str, test_size: float = 0.2,
                max_rows: int = 1_000_000):
    """Row (entity, date, key) that ends the training part when rows are sorted by those columns.

    Works down in three counted steps (entities, days of one entity, keys of
    one day), so nothing larger than ``max_rows`` groups is ordered in one task.
    Missing values come first, as in a sort.
    """
    n = df.count()
    want = int(n * (1 - test_size))
    if want == 0:
        return None
    narrowed, ends = df, []
    for col in (entity, date, key):
        groups = narrowed.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
        value, before = _value_at(groups, want, max_rows)
        ends.append(value)
        narrowed, want = narrowed.where(F.col(col).eqNullSafe(F.lit(value))), want - before
    return tuple(ends)


def _value_at(groups: DataFrame, want: int, max_rows: int):
    """(value, rows before it) of the sorted group that holds row number ``want``."""
    before = 0
    while groups.count() > max_rows:
        # split the ordered groups at about 1000 hashed values and keep the part holding the row
        share = min(1.0, 1000.0 / groups.count())
        cuts = [r["v"] for r in groups.where(F.col("v").isNotNull() & (uniform(F.col("v"), "cut") < share)).select("v").orderBy("v").collect()]
        if not cuts:
            break
        part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("v")))
        sums = (groups.groupBy(part.alias("p")).agg(F.sum("c").alias("c")).orderBy("p").collect())
        for r in sums:
            if want <= before + r["c"]:
                low = cuts[r["p"] - 1] if r["p"] > 0 else None
                high = cuts[r["p"]] if r["p"] < len(cuts) else None
                if low is not None:
                    groups = groups.where(F.col("v") >= F.lit(low))
                if high is not None:
                    groups = groups.where((F.col("v") < F.lit(high)) | F.col("v").isNull())
                break
            before += r["c"]
    w = W.orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    hit = (groups.withColumn("upto", F.sum("c").over(w) + before).where(F.col("upto") >= want)
                 .orderBy("v").limit(1).first())
    return hit["v"], hit["upto"] - hit["c"]


def positional_split(df: DataFrame, entity: str, date: str, key: str, test_size: float = 0.2,
                     max_rows: int = 1_000_000) -> DataFrame:
    """Add ``is_train``: 1 for the first int(n * (1 - test_size)) rows sorted by (entity, date, key).

    Only the boundary row is searched; marking rows is a filter, no sort of the data.
    """
    end = split_point(df, entity, date, key, test_size, max_rows)
    if end is None:
        return df.withColumn("is_train", F.lit(0))
    here = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate((entity, date, key))])
    stop = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(f"k{i}")
                      for i, (c, v) in enumerate(zip((entity, date, key), end))])
    return df.withColumn("is_train", (here <= stop).cast("int"))
