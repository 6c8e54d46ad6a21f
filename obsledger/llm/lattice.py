"""Near duplicates among embeddings by lattice hashing.

In every table a vector's direction is projected to 8 random dimensions, scaled and decoded to the nearest point of
the E8 lattice; that point names its cell. A vector lies in its own cell and also probes the ``probes`` lattice
neighbours of its point that are nearest to it. Who meets in a cell is verified by the cosine in double precision.

Equal vectors are one node with a number of copies, so copies cost nothing. A pair may meet in several tables and
from both sides; it counts only at its first meeting in a fixed order, which both vectors can tell from their own
cells. So a cell gives back, for each linked node, a number of links and a spanning forest, never the pairs. Cells
of more than ``cell_rows`` nodes are split into a grid of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.components import components
from obsledger.session import cut_lineage

DIMS = 8
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates +-1, or all +-1/2 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(DIMS), 2):
        for a, b in product((-1.0, 1.0), repeat=2):
            v = [0.0] * DIMS
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in product((-0.5, 0.5), repeat=DIMS) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole-number points with an even sum: round, and where the sum is odd, round the worst coordinate the other way."""
    y = np.rint(x)
    odd = np.flatnonzero(y.sum(axis=1) % 2)
    off = x[odd] - y[odd]
    worst = np.abs(off).argmax(axis=1)
    y[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return y


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by 1/2 in all coordinates; the nearer one of both nearest points."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def cells(unit: np.ndarray, table: int, probes: int, scale: float, seed: int) -> np.ndarray:
    """64-bit cell names: column 0 a vector's own, then those of its nearest lattice neighbours."""
    turn = np.random.default_rng([seed, table, unit.shape[1]]).standard_normal((unit.shape[1], DIMS))
    x = unit @ turn * scale
    own, around = nearest_e8(x), neighbours()
    nearer = np.argsort(-((x - own) @ around.T), axis=1, kind="stable")[:, :probes]
    points = np.concatenate([own[:, None, :], own[:, None, :] + around[nearer]], axis=1)
    named = ((2 * points).astype(np.int64).view(np.uint64) * MIX).sum(axis=2)
    named = (named ^ (named >> np.uint64(31))) * MIX[1] + np.array([table], np.uint64)
    named = (named ^ (named >> np.uint64(32))) * MIX[2]
    return (named ^ (named >> np.uint64(29))).view(np.int64)


def units(vectors: np.ndarray) -> np.ndarray:
    """Directions, by the largest coordinate first so that nothing overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class Meetings:
    """Which of a pair's meetings is its first, over tables and sides."""

    def __init__(self, unit: np.ndarray, tables: int, probes: int, scale: float, seed: int):
        self.names = [cells(unit, t, probes, scale, seed) for t in range(tables)]

    def before(self, table: int, a: np.ndarray, b: np.ndarray, smaller_probes: np.ndarray) -> np.ndarray:
        """Whether the pairs (a probes b's cell in ``table``) met earlier; a smaller node's probe comes first in a table."""
        met = np.zeros(len(a), bool)
        for t in range(table):
            names = self.names[t]
            met |= (names[a] == names[b, :1]).any(axis=1) | (names[b] == names[a, :1]).any(axis=1)
        names = self.names[table]
        return met | (~smaller_probes & (names[b] == names[a, :1]).any(axis=1))


def near_vectors(rows: DataFrame, cosine: float = 0.93, tables: int = 12, probes: int = 2, scale: float = 0.8,
                 cell_rows: int = 4000, seed: int = 7, vec_id: str = "vec_id", embedding: str = "embedding",
                 label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows``.

    Two vectors are linked if their labels are equal and not null, they have as many dimensions, and their cosine is at least
    ``cosine``; n_links counts the other rows linked directly, component_id is the least vec_id reachable. Vectors
    that are null, empty or zero, or hold nulls, NaN or infinities, have no links. A row whose component has no id but
    null keeps null and is kept if it has no links. Repeated rows are vectors of their own, linked with each other.
    No rows give no rows. Links are found with high probability (the tests hold the recall against brute force), and
    none below ``cosine`` is given.
    """
    given = rows.schema[embedding].dataType.simpleString()
    numbers = given if given in ("array<float>", "array<double>") else "array<double>"  # cells carry what was given
    vector = rows[embedding].cast(numbers)
    sound = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = sound & F.exists(vector, lambda x: x != 0) & rows[label].isNotNull()
    base = rows.select(rows[vec_id].alias("vec_id"), F.when(F.coalesce(sound, F.lit(False)), F.struct(
        rows[label].cast("string").alias("label"), vector.alias("v"))).alias("key"))
    least = F.min(F.struct(F.col("vec_id").isNull().alias("n"), F.col("vec_id").alias("i")))
    classes = base.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("copies"), least.alias("least"))
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(("node", "copies", "label", "v"))}
            sizes = columns["v"].value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(sizes):
                at = np.flatnonzero(sizes == width)
                take = pa.array(at)
                some = columns["v"].take(take)
                unit = units(some.flatten().to_numpy().astype(float).reshape(len(at), width))
                for t in range(tables):
                    names = cells(unit, t, probes, scale, seed)
                    again = pa.array(np.repeat(np.arange(len(at)), probes + 1))
                    role = np.tile(np.array([2] + [1] * probes, np.int8), len(at))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names.ravel()), pa.array(np.full(len(role), t, np.int32)), pa.array(role),
                        *(columns[n].take(take).take(again) for n in ("node", "copies", "label")), some.take(again)],
                        ["cell", "t", "role", "node", "copies", "label", "v"])

    entered = classes.select("node", "copies", "key.label", "key.v").mapInArrow(
        enter, f"cell long, t int, role byte, node long, copies long, label string, v {numbers}")
    # labels part cells too, so that a cell holds vectors of one label and width
    entered = entered.withColumn("cell", F.xxhash64("cell", "label", F.size("v")))

    def meet(node: np.ndarray, copies: np.ndarray, role: np.ndarray, labels: np.ndarray, unit: np.ndarray,
             t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Node, links that are counted here and least node of its links' component, for every node linked in a cell."""
        probing, home = np.flatnonzero(role > 0), np.flatnonzero(role != 1)
        left, right = [], []
        for at in range(0, len(probing) if len(home) else 0, 512):
            some = probing[at:at + 512]
            i, j = np.nonzero(unit[some] @ unit[home].T >= cosine - 1e-9)
            left.append(some[i])
            right.append(home[j])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        good = (node[a] != node[b]) & (labels[a] == labels[b])
        a, b = a[good], b[good]
        exact = np.concatenate([(unit[a[n:n + 65536]] * unit[b[n:n + 65536]]).sum(axis=1) for n in range(0, len(a), 65536)]
                               or [np.zeros(0)]) >= cosine
        a, b = a[exact], b[exact]
        if not len(a):
            return None
        names, back = np.unique(node[np.concatenate([a, b])], return_inverse=True)
        row = np.empty(len(names), np.int64)
        row[back] = np.concatenate([a, b])  # a grid's block may hold a node twice, as probe and as home
        x, y = back[:len(a)], back[len(a):]
        meetings = Meetings(unit[row], tables, probes, scale, seed)
        new = np.concatenate([~meetings.before(t, x[n:n + 65536], y[n:n + 65536], names[x[n:n + 65536]] < names[y[n:n + 65536]])
                              for n in range(0, len(a), 65536)])
        # the pair seen from both sides in one cell of homes is told apart by its smaller node's probe coming first
        links = np.bincount(x[new], weights=copies[row][y[new]], minlength=len(names))
        links += np.bincount(y[new], weights=copies[row][x[new]], minlength=len(names))
        root = np.arange(len(names))
        while True:
            low, before = np.minimum(root[x], root[y]), root.copy()
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            root = root[root]
            if (root == before).all():
                return names, links.astype(np.int64), names[root]

    def meet_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(part: pa.Table) -> Iterator[pa.RecordBatch]:
            part = part.combine_chunks()
            cell, node, copies, role, t = (part.column(c).to_numpy() for c in ("cell", "node", "copies", "role", "t"))
            labels, v = part.column("label").to_numpy(), part.column("v").combine_chunks()
            first = v.offsets.to_numpy()
            flat, out = v.values.to_numpy(), []
            cuts = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
            for g in np.flatnonzero(np.diff(cuts) > 1).tolist():
                lo, hi = int(cuts[g]), int(cuts[g + 1])
                unit = units(flat[first[lo]:first[hi]].astype(float).reshape(hi - lo, -1))
                out.append(meet(node[lo:hi], copies[lo:hi], role[lo:hi], labels[lo:hi], unit, int(t[lo])))
            out = [o for o in out if o]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["node", "links", "root"])

        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:  # rows come sorted by cell: what the last cell of a batch misses follows
            if not len(batch):
                continue
            waiting.append(batch)
            size += len(batch)
            if size >= 20_000:
                part = pa.Table.from_batches(waiting)
                cell = part.column("cell").to_numpy()
                stop = int(np.searchsorted(cell, cell[-1]))
                if stop:
                    yield from settled(part.slice(0, stop))
                    waiting, size = part.slice(stop).combine_chunks().to_batches(), size - stop
        if waiting:
            yield from settled(pa.Table.from_batches(waiting))

    homes = cut_lineage(entered.where("role = 2").groupBy("cell").count().where(F.col("count") > cell_rows))
    grouped = entered
    if not homes.isEmpty():
        # a grid over each crowded cell: every probing block meets every home block
        grid = entered.join(homes, "cell").withColumn("n", F.ceil(F.col("count") / cell_rows).cast("int"))
        every, kept = F.explode(F.sequence(F.lit(0), F.col("n") - 1)), ["t", "role", "node", "copies", "label", "v"]
        home = grid.where("role = 2").withColumn("role", F.lit(0).cast("byte")).withColumn(
            "h", F.pmod(F.xxhash64("node", F.lit(1)), "n").cast("int")).withColumn("p", every)
        probe = grid.withColumn("role", F.lit(1).cast("byte")).withColumn(
            "p", F.pmod(F.xxhash64("node", F.lit(2)), "n").cast("int")).withColumn("h", every)
        named = F.xxhash64("cell", "h", "p").alias("cell")
        grouped = entered.join(homes, "cell", "left_anti").select("cell", *kept).union(
            home.select(named, *kept)).union(probe.select(named, *kept))
    found = cut_lineage(grouped.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        meet_all, "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "root").toDF("linked", "root")
    rooted = classes.join(roots, classes["node"] == roots["linked"], "left").select(
        "key", "node", "copies", "least", F.coalesce("root", "node").alias("root"))
    best = rooted.groupBy("root").agg(F.min("least").alias("best"))
    named = rooted.join(best, "root").join(links.toDF("ln", "links"), F.col("node") == F.col("ln"), "left").select(
        F.col("key").alias("k"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("best.i").alias("component"))
    joined = base.join(named, base["key"] == named["k"], "left")
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    n_links = F.coalesce("n_links", F.lit(0)).cast("long")
    return joined.select("vec_id", n_links.alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, n_links == 0).alias("kept"))
