"""Exact density clustering (DBSCAN) as joins on grid cells.

Points are first reduced to distinct coordinates with a weight, so any number
of copies is one point. A fine grid whose cell diagonal is at most eps gives
*dense* cells: with at least ``min_samples`` points in it, every point of the
cell is a core point and all belong together. Dense cells enter the neighbour
search as one unit, so no pairs inside them are ever formed; the remaining
cells hold fewer than ``min_samples`` points each. More than three columns are searched by pivots (``pivots``), which
keep neighbours apart from the rest in any number of dimensions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.models import pivots
from obsledger.operators.timeline import rank_by
from obsledger.session import cut_lineage

# Points of one grid cell handled together on one side of the neighbour join.
CELL_POINTS = 20_000


def _points(df: DataFrame, key: str, cols: Sequence[str], eps: float, dims: int) -> DataFrame:
    """Distinct points: pid (smallest key), weight, coordinates x, fine cell, coarse cell."""
    p = len(cols)
    fine = math.isqrt(p - 1) + 2  # more fine steps than sqrt(p) per eps
    side = eps / fine
    x = F.array(*[F.col(c).cast("double") for c in cols])
    return (
        df.select(F.col(key).alias("key"), x.alias("x"))
        .groupBy("x").agg(F.min("key").alias("pid"), F.count(F.lit(1)).alias("w"))
        .withColumn("fine", F.transform("x", lambda v: F.floor(v / side)))
        .withColumn("coarse", F.array(*[F.floor(F.col("fine")[i] / fine) for i in range(dims)]))
    )


def _distance2(a: Column, b: Column, p: int) -> Column:
    """Squared distance, added up in column order."""
    return sum(((a[i] - b[i]) * (a[i] - b[i]) for i in range(p)), F.lit(0.0))


def _around(coarse: Column, dims: int) -> Column:
    """All 3^dims neighbour cells of a coarse cell."""
    return F.array(*[
        F.array(*[coarse[i] + s for i, s in enumerate(steps)]) for steps in product((-1, 0, 1), repeat=dims)])


def neighbourhoods(df: DataFrame, key: str, cols: Sequence[str], eps: float, min_samples: int,
                   dims: int | None = None):
    """(points, near): points with their unit, and near(a, unit, w) for points outside dense cells.

    A unit is a dense cell (named by its smallest pid) or a single point.
    ``w`` is the weight of the unit's points within eps of a.
    """
    p = len(cols)
    dims = dims or min(p, 3)
    pts = _points(df, key, cols, eps, dims)
    cells = pts.groupBy("fine").agg(F.sum("w").alias("cell_w"), F.min("pid").alias("cell_pid"))
    pts = (
        pts.join(cells, "fine")
        .withColumn("dense", F.col("cell_w") >= min_samples)
        .withColumn("unit", F.when(F.col("dense"), F.col("cell_pid")).otherwise(F.col("pid")))
        .select("pid", "w", "x", "fine", "coarse", "dense", "unit")
    )
    pts = cut_lineage(pts)
    # crowded coarse cells are split; a point beside one meets every part of it
    crowd = (pts.groupBy("coarse").agg(F.count(F.lit(1)).alias("n"))
                .select("coarse", F.ceil(F.col("n") / CELL_POINTS).cast("int").alias("parts")))
    right = (
        pts.join(crowd, "coarse")
        .select(F.col("coarse").alias("cell"), F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int").alias("part"),
                "unit", "w", F.col("x").alias("xb"))
    )
    left = (
        pts.where(~F.col("dense"))
        .select(F.col("pid").alias("a"), F.col("x").alias("xa"), F.explode(_around(F.col("coarse"), dims)).alias("cell"))
        .join(crowd.withColumnRenamed("coarse", "cell"), "cell")
        .select("a", "xa", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    )
    near = (
        left.join(right, ["cell", "part"])
        .where(_distance2(F.col("xa"), F.col("xb"), p) <= eps * eps)
        .groupBy("a", "unit").agg(F.sum("w").alias("w"))
    )
    return pts, cut_lineage(near)


def neighbour_counts(pts: DataFrame, near: DataFrame, min_samples: int) -> DataFrame:
    """(pid, is_core) of every distinct point; points of dense cells are core without counting."""
    counted = near.groupBy(F.col("a").alias("pid")).agg((F.sum("w") >= min_samples).alias("is_core"))
    return (pts.select("pid", "dense").join(counted, "pid", "left")
               .select("pid", (F.col("dense") | F.coalesce("is_core", F.lit(False))).alias("is_core")))


def _box_bounds(p: int, eps: float):
    """(surely within eps, surely beyond eps) of two boxes given as lo1, hi1, lo2, hi2 arrays."""
    near2 = far2 = F.lit(0.0)
    for i in range(p):
        lo1, hi1, lo2, hi2 = (F.col(c)[i] for c in ("lo1", "hi1", "lo2", "hi2"))
        gap = F.greatest(lo2 - hi1, lo1 - hi2, F.lit(0.0))
        reach = F.greatest(hi2 - lo1, hi1 - lo2)
        near2, far2 = near2 + gap * gap, far2 + reach * reach
    return far2 <= eps * eps, near2 > eps * eps


def _dense_links(pts: DataFrame, eps: float, p: int, dims: int) -> DataFrame:
    """Pairs of dense cells with two points within eps, found by halving boxes.

    A pair of boxes is settled when the furthest corners are within eps or the
    closest faces are not; only unsettled boxes are halved again. Boxes shrink
    to single points, so the answer is exact.
    """
    fine = math.isqrt(p - 1) + 2
    dense = pts.where("dense").select("unit", "x", "coarse", "fine")

    def boxes(level: int) -> DataFrame:
        half = eps / fine / (1 << level)
        return (
            dense.select("unit", "x", F.transform("x", lambda v: F.floor(v / half)).alias("sub"),
                         F.transform("x", lambda v: F.floor(v / (half * 2))).alias("parent"))
            .groupBy("unit", "sub", "parent")
            .agg(F.array(*[F.min(F.col("x")[i]) for i in range(p)]).alias("lo"),
                 F.array(*[F.max(F.col("x")[i]) for i in range(p)]).alias("hi"))
        )

    sure, never = _box_bounds(p, eps)
    units = dense.groupBy("unit", "coarse", "fine").agg(
        F.array(*[F.min(F.col("x")[i]) for i in range(p)]).alias("lo"),
        F.array(*[F.max(F.col("x")[i]) for i in range(p)]).alias("hi"))
    a = units.select(F.col("unit").alias("u1"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"),
                     F.col("fine").alias("s1"), F.explode(_around(F.col("coarse"), dims)).alias("cell"))
    b = units.select(F.col("unit").alias("u2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                     F.col("fine").alias("s2"), F.col("coarse").alias("cell"))
    open_ = cut_lineage(
        a.join(b, "cell").where((F.col("u1") < F.col("u2")) & ~never)
        .select("u1", "u2", "s1", "s2", sure.alias("sure")))
    links, level = open_.where("sure").select("u1", "u2").distinct(), 0
    open_ = open_.join(links, ["u1", "u2"], "left_anti").drop("sure")
    while not open_.isEmpty():
        level += 1
        box = boxes(level)
        c1 = box.select(F.col("unit").alias("u1"), F.col("parent").alias("s1"), F.col("sub").alias("t1"),
                        F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
        c2 = box.select(F.col("unit").alias("u2"), F.col("parent").alias("s2"), F.col("sub").alias("t2"),
                        F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        step = cut_lineage(
            open_.join(c1, ["u1", "s1"]).join(c2, ["u2", "s2"]).where(~never)
            .select("u1", "u2", F.col("t1").alias("s1"), F.col("t2").alias("s2"), sure.alias("sure")))
        found = step.where("sure").select("u1", "u2").distinct()
        links = links.unionByName(found)
        open_ = step.join(found, ["u1", "u2"], "left_anti").drop("sure")
    return links


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root): smallest node reachable from each node over undirected (u, v) edges.

    Alternating star steps: every round links each node's larger neighbours,
    then all its neighbours, to the smallest one, until nothing changes.
    """
    def smallest(pairs):
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def both(pairs):
        return pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    pairs = cut_lineage(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        # large star: neighbours above a node point to the smallest of its neighbourhood
        around = both(pairs)
        low = smallest(around).withColumn("m", F.least("m", "u"))
        large = (around.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: a node and its smaller neighbours point to the smallest of them
        low = smallest(large)
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        small = cut_lineage(small)
        if small.join(pairs, ["u", "v"], "left_anti").isEmpty() and pairs.join(small, ["u", "v"], "left_anti").isEmpty():
            break
        pairs = small
    return nodes.join(pairs.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))


def dbscan(df: DataFrame, key: str, cols: Sequence[str], eps: float = 0.5, min_samples: int = 5,
           dims: int | None = None) -> DataFrame:
    """Add ``dbscan_cluster`` (-1 for noise) and ``is_anomaly``.

    ``key`` is a unique number per row. Clusters are numbered by their smallest
    core key; a border point takes the smallest number among its core neighbours. In more than three columns rows with a missing
    or infinite number are noise.
    """
    p = len(cols)
    wide = p > 3 and dims is None  # a grid of 3 dimensions would not part the points
    if wide:
        coordinates = F.array(*[F.col(c).cast("double") for c in cols])
        distinct = df.select(F.col(key).alias("key"), coordinates.alias("x")).groupBy("x").agg(F.min("key").alias("pid"), F.count(F.lit(1)).alias("w"))
        known = distinct.where(F.forall("x", lambda v: F.coalesce(F.abs(v) < math.inf, F.lit(False))))  # the others are near nothing
        placed = pivots.place(known, eps, min_samples, p)
        pts, links = placed.points, pivots.unit_links(placed.points, placed.pivots, eps)
        core = cut_lineage(pivots.core_points(placed, min_samples).union(pts.where("dense").select("pid")))
    else:
        dims = dims or min(p, 3)
        pts, near = neighbourhoods(df, key, cols, eps, min_samples, dims)
        links = _dense_links(pts, eps, p, dims)
        core = cut_lineage(neighbour_counts(pts, near, min_samples).where("is_core").select("pid"))
    # units that are core: dense cells and core points
    units = pts.where("dense").select(F.col("unit").alias("node")).union(
        pts.where(~F.col("dense")).join(core, "pid", "left_semi").select(F.col("pid").alias("node"))).distinct()
    linked = links.select(F.col("u1").alias("u"), F.col("u2").alias("v"))
    if wide:
        core_pts = cut_lineage(pts.join(core, "pid", "left_semi"))
        edges = pivots.core_links(placed, core_pts).unionByName(linked)
    else:
        near_core = near.join(units.select(F.col("node").alias("unit")), "unit", "left_semi")
        edges = (near_core.join(core.select(F.col("pid").alias("a")), "a", "left_semi")
                 .select(F.col("a").alias("u"), F.col("unit").alias("v")).unionByName(linked))
    roots = components(edges, units)
    numbers = roots.select("root").distinct()
    numbers = rank_by(numbers, "root", "number", desc=False).select("root", (F.col("number") - 1).cast("int").alias("number"))
    unit_number = roots.join(numbers, "root").select(F.col("node").alias("unit"), "number")
    if wide:
        unit_number = cut_lineage(unit_number)
        border = pivots.border_numbers(placed, pts.join(core, "pid", "left_anti"), core_pts.join(unit_number, "unit"))
    else:
        border = (near_core.join(core.select(F.col("pid").alias("a")), "a", "left_anti")
                  .join(unit_number, "unit").groupBy(F.col("a").alias("pid")).agg(F.min("number").alias("border")))
    labels = (
        pts.select("pid", "x", "unit").join(unit_number, "unit", "left").join(border, "pid", "left")
        .select(F.col("x").alias("_point"), F.coalesce("number", "border", F.lit(-1)).alias("dbscan_cluster"))
    )
    x = F.array(*[F.col(c).cast("double") for c in cols])
    labelled = df.withColumn("_point", x).join(labels, "_point", "left" if wide else "inner").drop("_point")
    if wide:
        labelled = labelled.withColumn("dbscan_cluster", F.coalesce("dbscan_cluster", F.lit(-1)))
    return (labelled
              .withColumn("is_anomaly", (F.col("dbscan_cluster") == -1).cast("int")))


def measures(labelled: DataFrame, label: str = "dbscan_cluster") -> dict[str, float]:
    """Numbers of clusters and noise rows, and the noise in percent of all rows."""
    row = labelled.agg(F.count_distinct(F.when(F.col(label) >= 0, F.col(label))).alias("n_clusters"),
                       F.count_if(F.col(label) == -1).alias("n_noise_points"),
                       (100 * F.avg((F.col(label) == -1).cast("double"))).alias("noise_percentage")).first()
    return row.asDict()
