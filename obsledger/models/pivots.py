"""Neighbours within eps in many dimensions, by pivots instead of a grid.

At most ``PIVOTS`` points, drawn by hash, become pivots; every point belongs to its nearest one. A point has to look into
another pivot's cell only if the plane between the two pivots, and the cell's furthest point, are within eps of it (triangle inequality),
so nothing is missed and the distance is checked at the end. Points within half of eps of their pivot are all neighbours of each
other: where they weigh ``min_samples`` they are core points and one unit, and no pairs among them are formed. As pivots fall where the
points are, a crowd of points is covered by such units however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsledger.models.margin import _matrix, numbers
from obsledger.session import cut_lineage

PIVOTS = 4096
POINTS_PER_PIVOT = 200
BLOCK = 20_000  # points of one side that meet in a task
SPREAD = 16  # fewer points are dealt into this many blocks, of LEAST points at least
LEAST = 1_000
PRODUCTS = 4_000_000  # pairs compared at once
CLOSE = 1e-7  # share of the squares within which a product leaves a pair unsettled
SAMPLED = 32  # points of a unit that stand for it before all of them are compared
SLACK = 1e-9


def within(a: np.ndarray, b: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows at most eps apart. One product finds the pairs; where it is not sure, sums in column order decide."""
    middle = b.mean(0) if len(b) else 0.0
    a0, b0, e = a - middle, b - middle, eps * eps
    sa, sb = (a0 ** 2).sum(1), (b0 ** 2).sum(1)
    rows = np.column_stack([a0, np.ones(len(a0)), ((1 + CLOSE) * e - (1 - CLOSE) * sa) / 2])
    cols = np.column_stack([b0, (CLOSE - 1) * sb / 2, np.ones(len(b0))])
    score = rows @ cols.T  # half of eps^2 less the squared distance, and a margin for rounding
    flat = np.flatnonzero(score >= 0)
    i, j = np.divmod(flat, max(len(b), 1))
    unsure = np.flatnonzero(score.ravel()[flat] < CLOSE * (e + sa[i] + sb[j]))
    if len(unsure):
        total = np.zeros(len(unsure))
        for k in range(a.shape[1]):
            gap = a[i[unsure], k] - b[j[unsure], k]
            total += gap * gap
        keep = np.ones(len(i), bool)
        keep[unsure] = total <= e
        i, j = i[keep], j[keep]
    return i, j


def choose(points: DataFrame, n: int) -> np.ndarray:
    """Pivots: distinct points with the least hashes, at most PIVOTS of them."""
    most = int(min(PIVOTS, max(1, n // POINTS_PER_PIVOT)))
    drawn = points.select("x").orderBy(F.xxhash64("x"), "x").limit(most).collect()
    return np.array([r["x"] for r in drawn], float)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    middle = pivots.mean(0)
    x0, p0 = x - middle, pivots - middle
    return np.sqrt(np.maximum((x0 ** 2).sum(1)[:, None] + (p0 ** 2).sum(1)[None, :] - 2 * x0 @ p0.T, 0.0))


def _slices(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, 2_000_000 // width)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def in_cells(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``points`` (pid, w, x) with the nearest pivot's number and the distance to it."""
    p = pivots.shape[1]
    kind = points.schema["pid"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, len(pivots)):
                far = _distances(_matrix(part.column(2), p), pivots)
                cell = far.argmin(1)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], numbers(part.column(2)), pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell])],
                                                 ["pid", "w", "x", "cell", "far"])

    return points.select("pid", "w", "x").mapInArrow(run, f"pid {kind}, w long, x array<double>, cell int, far double")


@dataclass(frozen=True)
class Placed:
    """Points (pid, w, x, cell, far, block, dense, unit), what is known of their cells, and the pairs of blocks that have to meet."""

    points: DataFrame
    pivots: np.ndarray
    reach: np.ndarray  # furthest distance in each pivot's cell
    eps: float
    pairs: DataFrame  # (pair, block, side)
    n_pairs: int


def _grouped(pivots: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Cells in groups of near ones, halved until a group has at most ``size`` points or is one cell."""
    todo, out = [np.flatnonzero(counts > 0)], []
    while todo:
        cells = todo.pop()
        if len(cells) <= 1 or counts[cells].sum() <= size:
            out += [cells] if len(cells) else []
            continue
        cells = cells[np.argsort(pivots[cells, pivots[cells].var(0).argmax()], kind="stable")]
        upto = counts[cells].cumsum()
        at = min(max(int(np.searchsorted(upto, upto[-1] / 2)), 1), len(cells) - 1)
        todo += [cells[:at], cells[at:]]
    return out


def place(points: DataFrame, eps: float, min_samples: int, p: int) -> Placed:
    """Distinct weighted ``points`` (pid, w, x) with their cell, block and unit (a dense cell's least pid, else the own pid)."""
    points = cut_lineage(points)
    n = points.count()
    pivots = choose(points, n)
    if not len(pivots):
        pivots = np.zeros((1, p))
    placed = cut_lineage(in_cells(points, pivots))
    close = F.col("far") <= eps / 2 * (1 - SLACK)
    cells = cut_lineage(placed.groupBy("cell").agg(F.max("far").alias("reach"), F.count(F.lit(1)).alias("n"),
                                                   F.sum(F.when(close, F.col("w"))).alias("close_w"), F.min(F.when(close, F.col("pid"))).alias("close_pid")))
    reach, counts = np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64)
    for r in cells.collect():  # at most one row a pivot
        reach[r["cell"]], counts[r["cell"]] = r["reach"], r["n"]
    size = max(1, min(BLOCK, max(LEAST, n // SPREAD)))
    groups = _grouped(pivots, counts, size)
    parts = [max(1, -(-int(counts[g].sum()) // size)) for g in groups]
    first = np.concatenate([[0], np.cumsum(parts)]).astype(int)
    home = [(int(c), int(first[k]), parts[k]) for k, g in enumerate(groups) for c in g]
    meet = []
    for k, g in enumerate(groups):
        for m in range(k, len(groups)):
            apart = _distances(pivots[g], pivots[groups[m]]) - reach[g][:, None] - reach[groups[m]][None, :]
            if not (apart > eps + SLACK * (1 + np.abs(apart))).all():
                meet += [(a, b) for a in range(first[k], first[k + 1]) for b in range(first[m], first[m + 1]) if a <= b]
    spark = points.sparkSession
    homes = F.broadcast(spark.createDataFrame(home, "cell int, base int, parts int"))  # at most one row a pivot
    dense = close & (F.coalesce("close_w", F.lit(0)) >= min_samples)
    pts = placed.join(F.broadcast(cells.drop("reach", "n")), "cell").join(homes, "cell").select(
        "pid", "w", "x", "cell", "far", (F.col("base") + F.pmod(F.xxhash64("pid"), "parts")).cast("int").alias("block"),
        dense.alias("dense"), F.when(dense, F.col("close_pid")).otherwise(F.col("pid")).alias("unit"))
    sides = [(k, int(b), s) for k, ab in enumerate(meet) for s, b in enumerate(ab) if s == 0 or ab[0] != ab[1]]
    return Placed(cut_lineage(pts), pivots, reach, eps, cut_lineage(spark.createDataFrame(sides, "pair int, block int, side int")), len(meet))


@dataclass
class Side:
    """Points of one block in a task."""

    x: np.ndarray
    cell: np.ndarray
    far: np.ndarray
    table: pa.Table

    def take(self, keep: np.ndarray) -> Side:
        return Side(self.x[keep], self.cell[keep], self.far[keep], self.table.take(pa.array(np.flatnonzero(keep))))

    def numbers(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy()


def near_pairs(a: Side, b: Side, pivots: np.ndarray, reach: np.ndarray, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of points at most eps apart, some at a time. Cells out of a point's reach are left out where that saves work."""
    if not (len(a.x) and len(b.x)):
        return
    cells, which = np.unique(b.cell, return_inverse=True)
    homes, own = np.unique(a.cell, return_inverse=True)
    far = _distances(a.x, pivots[cells])
    apart = _distances(pivots[homes], pivots[cells])[own]
    open_ = (far ** 2 - a.far[:, None] ** 2 <= 2 * eps * apart + SLACK * (1 + far ** 2)) & (far <= reach[cells][None, :] + eps + SLACK * (1 + far))
    if (open_ @ np.bincount(which)).sum() > 0.5 * len(a.x) * len(b.x):
        todo = [(np.arange(len(a.x)), np.arange(len(b.x)))]
    else:
        order = np.argsort(which, kind="stable")
        ends = np.cumsum(np.bincount(which))
        todo = [(np.flatnonzero(open_[:, k]), order[ends[k - 1] if k else 0:ends[k]]) for k in range(len(cells))]
    for rows, cols in todo:
        xb = b.x[cols]
        step = max(1, PRODUCTS // len(cols))
        for at in range(0, len(rows), step):
            i, j = within(a.x[rows[at:at + step]], xb, eps)
            yield rows[at + i], cols[j]


def _met(placed: Placed, points: DataFrame, work, schema: str) -> DataFrame:
    """``work(a, b, same)`` on the points of every pair of blocks; ``same`` if both are one block. It returns Arrow columns."""
    p = placed.pivots.shape[1]
    fields = [f.split()[0] for f in schema.split(", ")]

    def meet(table: pa.Table) -> pa.Table:
        sides = []
        for s in (0, 1):
            part = table.filter(pc.equal(table.column("side"), s))
            sides.append(Side(_matrix(part.column("x"), p), part.column("cell").to_numpy(), part.column("far").to_numpy(), part))
        same = not sides[1].table.num_rows and pc.all(table.column("alone")).as_py()
        return pa.table(work(sides[0], sides[0] if same else sides[1], same), fields)

    pairs = placed.pairs.withColumn("alone", F.count(F.lit(1)).over(Window.partitionBy("pair")) == 1)
    both = points.join(pairs, "block").repartition(max(1, min(placed.n_pairs, 1000)), "pair")
    return both.groupBy("pair").applyInArrow(meet, schema)


def core_points(placed: Placed, min_samples: int) -> DataFrame:
    """(pid) of the points outside units with weight ``min_samples`` within eps. A task gives back one sum a point."""
    kind = placed.points.schema["pid"].dataType.simpleString()
    pivots, reach, eps = placed.pivots, placed.reach, placed.eps

    def count(a: Side, b: Side, same: bool) -> list:
        sums = [np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)]
        lone_a, lone_b = (~s.table.column("dense").to_numpy(zero_copy_only=False).astype(bool) for s in (a, b))
        wa, wb = a.numbers("w"), b.numbers("w")

        def add(keep_a, keep_b, to_a, to_b):
            ia, ib = np.flatnonzero(keep_a), np.flatnonzero(keep_b)
            for i, j in near_pairs(a.take(keep_a), b.take(keep_b), pivots, reach, eps):
                i, j = ia[i], ib[j]
                if to_a:
                    sums[0] += np.bincount(i, wb[j], len(a.x)).astype(np.int64)
                if to_b:
                    sums[1] += np.bincount(j, wa[i], len(b.x)).astype(np.int64)

        add(lone_a, np.ones(len(b.x), bool), True, not same)
        if not same:
            add(~lone_a, lone_b, False, True)
        names = [a.table.column("pid"), *([] if same else [b.table.column("pid")])]
        total = np.concatenate(sums[:1] if same else sums)
        lone = np.concatenate([lone_a] if same else [lone_a, lone_b]) & (total > 0)
        pid = pa.chunked_array([c for n in names for c in n.chunks], names[0].type)
        return [pid.filter(pa.array(lone)), pa.array(total[lone])]

    met = _met(placed, placed.points.select("pid", "w", "x", "cell", "far", "block", "dense"), count, f"pid {kind}, w long")
    return met.groupBy("pid").agg(F.sum("w").alias("w")).where(F.col("w") >= min_samples).select("pid")


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least node of each node's component once the pairs (i, j) are linked too."""
    while True:
        u, v = label[i], label[j]
        open_ = u != v
        if not open_.any():
            return label
        i, j, u, v = i[open_], j[open_], u[open_], v[open_]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while (label[label] != label).any():
            label = label[label]


def core_links(placed: Placed, cores: DataFrame) -> DataFrame:
    """(u, v): links that join all core units with points within eps, dense ones among themselves left out.

    A task gives back a star for each of its components, so at most one link a unit. ``cores`` are the placed core points.
    """
    kind = placed.points.schema["pid"].dataType.simpleString()
    pivots, reach, eps = placed.pivots, placed.reach, placed.eps

    def link(a: Side, b: Side, same: bool) -> list:
        units = pa.chunked_array([*a.table.column("unit").chunks, *([] if same else b.table.column("unit").chunks)], a.table.column("unit").type)
        codes = units.combine_chunks().dictionary_encode()
        names = codes.dictionary
        label = np.arange(len(names))
        ua = codes.indices.to_numpy()[:len(a.x)]
        ub = ua if same else codes.indices.to_numpy()[len(a.x):]
        lone_a, lone_b = (~s.table.column("dense").to_numpy(zero_copy_only=False).astype(bool) for s in (a, b))
        for keep_a, keep_b in [(lone_a, np.ones(len(b.x), bool)), *([] if same else [(~lone_a, lone_b)])]:
            va, vb = ua[keep_a], ub[keep_b]
            for i, j in near_pairs(a.take(keep_a), b.take(keep_b), pivots, reach, eps):
                label = _joined(label, va[i], vb[j])
        moved = np.flatnonzero(label != np.arange(len(label)))
        return [names.take(pa.array(moved)), names.take(pa.array(label[moved]))]

    return _met(placed, cores.select("x", "cell", "far", "block", "dense", "unit"), link, f"u {kind}, v {kind}").distinct()


def border_numbers(placed: Placed, rest: DataFrame, cores: DataFrame) -> DataFrame:
    """(pid, border): least ``number`` of the ``cores`` within eps of each point of ``rest``, where there is one."""
    kind = placed.points.schema["pid"].dataType.simpleString()
    pivots, reach, eps = placed.pivots, placed.reach, placed.eps

    def least(a: Side, b: Side, same: bool) -> list:
        found, ids = [], []
        for one, two in [(a, b), *([] if same else [(b, a)])]:
            asks = one.table.column("number").is_null().to_numpy()
            gives = ~two.table.column("number").is_null().to_numpy()
            number = two.table.column("number").filter(pa.array(gives)).to_numpy()
            low = np.full(int(asks.sum()), np.iinfo(np.int32).max, np.int64)
            for i, j in near_pairs(one.take(asks), two.take(gives), pivots, reach, eps):
                np.minimum.at(low, i, number[j])
            got = low < np.iinfo(np.int32).max
            ids += one.table.column("pid").filter(pa.array(asks)).filter(pa.array(got)).chunks
            found.append(low[got])
        return [pa.chunked_array(ids, a.table.schema.field("pid").type), pa.array(np.concatenate(found), pa.int32())]

    cols = ["pid", "x", "cell", "far", "block"]
    both = rest.select(*cols, F.lit(None).cast("int").alias("number")).unionByName(cores.select(*cols, "number"))
    return _met(placed, both, least, f"pid {kind}, border int").groupBy("pid").agg(F.min("border").alias("border"))


def unit_links(pts: DataFrame, pivots: np.ndarray, eps: float) -> DataFrame:
    """(u1, u2): links that connect the dense units with points within eps of each other.

    Units are at most one a pivot. Pairs of pivots more than twice eps apart cannot touch. The others are first compared by a
    few points of each; only pairs that these leave unconnected are compared whole, in blocks, until a pair of points is found.
    """
    p = pivots.shape[1]
    kind = pts.schema["pid"].dataType.simpleString()
    dense = pts.where("dense").select("unit", "cell", "x", "pid")
    ranked = dense.select("unit", "cell", F.struct(F.xxhash64("pid").alias("h"), "x").alias("s"), F.pmod(F.xxhash64("pid"), F.lit(SAMPLED)).alias("slot"))
    few = ranked.groupBy("unit", "cell", "slot").agg(F.min("s").alias("s")).select("unit", "cell", F.col("s.x").alias("x")).collect()
    units = sorted({(r["cell"], r["unit"]) for r in few})
    empty = pts.sparkSession.createDataFrame([], f"u1 {kind}, u2 {kind}")
    if len(units) < 2:
        return empty
    place = {u: k for k, (_, u) in enumerate(units)}
    held: list[list] = [[] for _ in units]
    for r in few:
        held[place[r["unit"]]].append(r["x"])
    x = np.array([v for h in held for v in h], float)
    owner = np.repeat(np.arange(len(units)), [len(h) for h in held])
    centre = pivots[[c for c, _ in units]]
    root = np.arange(len(units))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    linked, open_pairs = [], []
    for at in range(0, len(x), 500):
        i, j = within(x[at:at + 500], x, eps)
        for a, b in np.unique(np.stack([owner[at + i], owner[j]], 1), axis=0).tolist():
            if find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
                linked.append((units[a][1], units[b][1]))
    for a in range(len(units)):
        gaps = _distances(centre[a:a + 1], centre)[0]
        open_pairs += [(a, int(b), float(gaps[b])) for b in np.flatnonzero(gaps <= 2 * eps + SLACK) if b > a and find(a) != find(int(b))]
    links = pts.sparkSession.createDataFrame(linked, empty.schema) if linked else empty
    if not open_pairs:
        return links
    pairs = pts.sparkSession.createDataFrame([(k, units[a][1], units[b][1]) for k, (a, b, _) in enumerate(open_pairs)], f"pair long, u1 {kind}, u2 {kind}")
    sizes = dense.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    one, two = sizes.toDF("u1", "lp"), sizes.toDF("u2", "rp")
    plan = pairs.join(one, "u1").join(two, "u2")
    left = (plan.join(dense.select(F.col("unit").alias("u1"), "x", "pid"), "u1").withColumn("l", F.pmod(F.xxhash64("pid"), "lp").cast("int"))
            .select("pair", "u1", "u2", "x", "l", F.explode(F.sequence(F.lit(0), F.col("rp") - 1)).alias("r")))
    right = (plan.join(dense.select(F.col("unit").alias("u2"), "x", "pid"), "u2").withColumn("r", F.pmod(F.xxhash64("pid"), "rp").cast("int"))
             .select("pair", "x", "r", F.explode(F.sequence(F.lit(0), F.col("lp") - 1)).alias("l")).toDF("pair", "x", "r", "l"))

    def touch(a: pa.Table, b: pa.Table) -> pa.Table:
        found = 0
        if a.num_rows and b.num_rows:
            xa, xb = _matrix(a.column("x"), p), _matrix(b.column("x"), p)
            axis = xb.mean(0) - xa.mean(0)
            axis /= max(np.sqrt((axis ** 2).sum()), 1e-300)
            sa, sb = xa @ axis, xb @ axis  # points further apart along the axis cannot touch
            xa, xb = xa[sa >= sb.min() - eps - SLACK * (1 + abs(sb.min()))], xb[sb <= sa.max() + eps + SLACK * (1 + abs(sa.max()))]
            if len(xa) and len(xb):
                xa, xb = xa[np.argsort(-(xa @ axis))], xb[np.argsort(xb @ axis)]
                step = max(1, min(500, PRODUCTS // len(xb)))
                for at in range(0, len(xa), step):
                    if len(within(xa[at:at + step], xb, eps)[0]):
                        found = 1
                        break
        return a.select(["u1", "u2"]).slice(0, found)

    more = left.groupBy("pair", "l", "r").cogroup(right.groupBy("pair", "l", "r")).applyInArrow(touch, f"u1 {kind}, u2 {kind}")
    return links.unionByName(more.distinct())
