"""k-means, nearest-centroid assignment, silhouette and principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.scalars import uniform
from obsledger.models.margin import NUMBERS, _matrix, _resident, numbers, sum_batches
from obsledger.operators.timeline import cumulative
from obsledger.session import cut_lineage


def _vectors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)


@dataclass(frozen=True)
class KMeansRuns:
    """All restarts of one fit: centres (restart x cluster x column), inertia, rounds and whether each run came to rest."""

    columns: tuple[str, ...]
    centres: np.ndarray
    inertia: np.ndarray
    rounds: np.ndarray
    converged: np.ndarray

    @property
    def best(self) -> int:
        return int(self.inertia.argmin())

    def centroids(self, spark) -> DataFrame:
        """(cluster, columns...) of the best run, numbered by ascending centroid."""
        schema = "cluster int, " + ", ".join(f"`{c}` double" for c in self.columns)
        rows = sorted(self.centres[self.best].tolist())
        return spark.createDataFrame([(i, *c) for i, c in enumerate(rows)], schema)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows x restarts x clusters."""
    runs, k, p = centres.shape
    flat = centres.reshape(-1, p)
    d2 = (x ** 2).sum(1)[:, None] + (flat ** 2).sum(1)[None, :] - 2 * x @ flat.T
    return np.maximum(d2, 0.0).reshape(len(x), runs, k)


def _seeds(rows: DataFrame, runs: Sequence[int], p: int, k: int, rounds: int = 4) -> list[np.ndarray]:
    """First centres of each restart: a few rounds that draw far rows by hash, weighed, then chosen among on the driver.

    Every restart holds about 2k candidates a round (their draws are independent hashes), so the driver sees a few dozen rows.
    """
    hashes = [F.xxhash64(F.lit(f"first {r}"), "x") for r in runs]
    firsts = rows.agg(*[F.min_by("x", h).alias(f"x{i}") for i, h in enumerate(hashes)]).first()
    found = [np.array([firsts[i]], float) for i in range(len(runs))]
    for turn in range(rounds):
        sizes = [len(c) for c in found]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        every = np.concatenate(found)

        def far(x: np.ndarray, every=every, bounds=bounds) -> np.ndarray:
            d2 = _squares(x, every[None])[:, 0]
            return np.stack([d2[:, a:b].min(1) for a, b in zip(bounds, bounds[1:])], 1)

        total = sum_batches(rows, lambda b, far=far: far(_matrix(b.column(0), p)).sum(0), len(runs))

        def draw(batches, far=far, total=total, turn=turn):
            for b in batches:
                x = _matrix(b.column(0), p)
                chance = 2 * k * far(x) / np.maximum(total, 1e-300)
                for i, r in enumerate(runs):
                    u = _uniform(b.column(1).to_numpy(), r * rounds + turn)
                    hit = np.flatnonzero(u < chance[:, i])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), i), pa.int32()), numbers(b.column(0).take(pa.array(hit)))], ["run", "x"])

        keyed = rows.select("x", F.xxhash64("x"))
        for r in keyed.mapInArrow(draw, "run int, x array<double>").distinct().collect():
            found[r["run"]] = np.concatenate([found[r["run"]], [r["x"]]])
    sizes = [len(c) for c in found]
    bounds, every = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(found)

    def weigh(b) -> np.ndarray:
        d2 = _squares(_matrix(b.column(0), p), every[None])[:, 0]
        return np.concatenate([np.bincount(d2[:, a:e].argmin(1), minlength=e - a) for a, e in zip(bounds, bounds[1:])]).astype(float)

    weights, out = sum_batches(rows, weigh, len(every)), []
    for r, a, e in zip(runs, bounds, bounds[1:]):
        rng, points, w = np.random.default_rng(r), every[a:e], weights[a:e]
        order = np.lexsort(points.T[::-1])
        points, w = points[order], np.maximum(w[order], 1e-12)
        chosen = [int(rng.choice(len(points), p=w / w.sum()))]
        while len(chosen) < k:
            cost = _squares(points, points[chosen][None])[:, 0].min(1) * w
            left = cost.sum()
            chosen.append(int(rng.choice(len(points), p=cost / left)) if left > 0 else chosen[len(chosen) % len(points)])
        out.append(points[chosen])
    return out


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys and a salt."""
    with np.errstate(over="ignore"):
        h = (keys.astype(np.int64).view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(float) / (1 << 53)


def fit_kmeans_runs(df: DataFrame, cols: Sequence[str], k: int = 4, restarts: int = 10, seed: int = 42, max_iter: int = 300,
                    tol: float = 1e-4) -> KMeansRuns:
    """All restarts side by side: each pass over the rows moves the centres of every run that has not come to rest.

    A run rests when its centres move by at most ``tol`` of the mean variance. What a run does depends on its seed (``seed`` plus
    its number) and the rows alone, not on the other runs. Rows with a missing measure are left out; no rows are refused.
    """
    p, runs = len(cols), [seed + i for i in range(restarts)]
    complete = df.dropna(subset=list(cols))
    rows = _resident(complete.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x")), complete.count())
    try:
        spread = rows.agg(*[F.var_pop(F.col("x")[j]) for j in range(p)]).first()
        if spread[0] is None:
            raise ValueError("no complete rows to cluster")
        rest = tol * float(np.mean(spread))
        centres = np.stack(_seeds(rows, runs, p, k))
        done, rounds, inertia = np.zeros(restarts, bool), np.zeros(restarts, int), np.zeros(restarts)

        def passed(centres: np.ndarray) -> np.ndarray:
            n = len(centres)

            def per_batch(b) -> np.ndarray:
                x = _matrix(b.column(0), p)
                d2 = _squares(x, centres)
                label, out = d2.argmin(2), np.zeros((n, k, p + 2))
                for r in range(n):
                    out[r, :, p] = np.bincount(label[:, r], minlength=k)
                    out[r, :, p + 1] = np.bincount(label[:, r], d2[np.arange(len(x)), r, label[:, r]], k)
                    for j in range(p):
                        out[r, :, j] = np.bincount(label[:, r], x[:, j], k)
                return out.ravel()

            return sum_batches(rows, per_batch, n * k * (p + 2)).reshape(n, k, p + 2)

        while not done.all() and rounds.max() < max_iter:
            live = np.flatnonzero(~done)
            sums = passed(centres[live])
            moved = np.where(sums[:, :, p:p + 1] > 0, sums[:, :, :p] / np.maximum(sums[:, :, p:p + 1], 1), centres[live])
            shift = ((moved - centres[live]) ** 2).sum((1, 2))
            centres[live], rounds[live] = moved, rounds[live] + 1
            done[live] = shift <= rest
        inertia = passed(centres)[:, :, p + 1].sum(1)
    finally:
        rows.unpersist()
    return KMeansRuns(tuple(cols), centres, inertia, rounds, done)


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int = 4, restarts: int = 10, seed: int = 42):
    """(centroids frame, inertia) of the best of ``restarts`` runs.

    Clusters are numbered by ascending centroid, so their ids do not depend on
    which restart won.
    """
    runs = fit_kmeans_runs(df, cols, k, restarts, seed)
    return runs.centroids(df.sparkSession), float(runs.inertia[runs.best])


# Above this many terms distances are written over arrays instead of one long expression.
LONG_EXPRESSION = 128


def _nearest(df: DataFrame, centres: list, square, out: str, distance: str) -> DataFrame:
    """Add the id and squared distance of the closest of ``centres`` [(id, numbers)]; ties go to the smaller id."""
    options = [F.struct(square(c).alias("d"), F.lit(i).alias("c")) for i, c in sorted(centres)]
    best = F.least(*options) if len(options) > 1 else options[0]
    best = F.when(best["d"].isNotNull(), best)  # a row with a missing measure has no cluster
    return (df.withColumn("_best", best)
              .select(*df.columns, F.col("_best.c").alias(out), F.col("_best.d").alias(distance)))


def _array_square(x):
    def square(centre):
        gaps = F.zip_with(x, F.array(*map(F.lit, centre)), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v)
    return square


def assign(df: DataFrame, centroids: DataFrame, cols: Sequence[str], out: str = "cluster",
           distance: str = "distance2") -> DataFrame:
    """Nearest centroid and squared distance to it.

    The centroids (k x columns numbers) become constants of one projection.
    """
    centres = [(r["cluster"], [float(r[c]) for c in cols]) for r in centroids.collect()]
    if len(centres) * len(cols) > LONG_EXPRESSION:
        return _nearest(df, centres, _array_square(F.array(*[F.col(c).cast("double") for c in cols])), out, distance)

    def square(centre):
        return sum(((F.col(c) - v) * (F.col(c) - v) for c, v in zip(cols, centre)), F.lit(0.0))

    return _nearest(df, centres, square, out, distance)


def assign_vectors(df: DataFrame, centroids: DataFrame, vector: str, out: str = "cluster",
                   distance: str = "distance2") -> DataFrame:
    """As ``assign`` for an array column; ``centroids`` has (cluster, centre array)."""
    centres = [(r["cluster"], [float(v) for v in r["centre"]]) for r in centroids.collect()]
    return _nearest(df, centres, _array_square(F.col(vector).cast("array<double>")), out, distance)


def inertia(assigned: DataFrame, distance: str = "distance2") -> DataFrame:
    return assigned.agg(F.sum(distance).alias("inertia"))


def silhouette(df: DataFrame, cluster: str, cols: Sequence[str], distance: str = "squared", share: float = 1.0) -> float:
    """Mean silhouette; 0 with a single cluster. ``distance``: "squared" (linear in the rows) or "euclidean".

    Plain distances are summed exactly from a ``share`` of the rows, drawn by hash, to all rows: blocks of distinct, weighted
    points meet in tasks that give back one sum for each point and cluster. The mean over n drawn rows is within about
    2 / sqrt(n) of that over all.
    """
    if df.select(cluster).distinct().limit(2).count() < 2:
        return 0.0
    if distance == "euclidean":
        return _plain_silhouette(df, cluster, list(cols), share)
    rows = _vectors(df, cols).select("features", F.col(cluster).cast("double").alias("prediction"))
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(rows)


# Points of one side that meet in a task.
QUERY_ROWS, POINT_ROWS = 20_000, 20_000
ASKED = 8  # queries are dealt into this many blocks at least, of LEAST points at least
LEAST = 500
TILE = 500, 1000  # pairs compared at once
SUMS = 4_000_000  # sums of points to clusters that one task adds up


def distances_to(b: np.ndarray):
    """Function of rows that gives their plain distances to ``b``: by a product of matrices or, where that leaves few digits (near points), by differences."""
    middle = np.median(b, axis=0)
    with np.errstate(invalid="ignore"):
        b0 = b - middle
        sb = (b0 ** 2).sum(1)
        cols, most = np.ascontiguousarray(np.column_stack([b0, sb, np.ones(len(b))]).T), sb.max()

    def distances(a: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            a0 = a - middle
            sa = (a0 ** 2).sum(1)
            total = np.column_stack([-2 * a0, np.ones(len(a)), sa]) @ cols
            near = np.flatnonzero(~(total > 1e-6 * (sa.max() + most)))
            i, j = np.divmod(near, len(b))
            exact = np.zeros(len(i))
            for k in range(a.shape[1]):
                gap = a[i, k] - b[j, k]
                exact += gap * gap
            total.ravel()[near] = exact
            return np.sqrt(total, out=total)

    return distances


def _blocks(points: DataFrame, parts: int, p: int) -> DataFrame:
    """(b, x, g, w): about ``parts`` blocks of points by hash, a row each, ordered by cluster; numbers of single precision take 4 bytes."""
    kind = points.schema["g"].dataType.simpleString()

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("g")
        x = _matrix(rows.column("x"), p)
        with np.errstate(over="ignore"):
            short = x.astype(np.float32)
        data = (short if (short == x).all() else x).tobytes()
        g = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column("g").combine_chunks())
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([data], pa.binary()), g, pa.array([rows.column("w").to_numpy().tobytes()], pa.binary())],
                        ["b", "x", "g", "w"])

    dealt = points.withColumn("b", F.pmod(F.xxhash64("x", "g"), F.lit(parts)).cast("int"))
    return cut_lineage(dealt.groupBy("b").applyInArrow(pack, f"b int, x binary, g array<{kind}>, w binary"))


def _plain_silhouette(df: DataFrame, cluster: str, cols: list[str], share: float) -> float:
    """Blocks travel as bytes, and a pair of blocks gives back 8 bytes for each point and cluster. With all rows asked, a pair meets
    once and serves both sides."""
    p = len(cols)
    x = F.array(*[F.col(c).cast("double") for c in cols])
    points = cut_lineage(df.dropna(subset=cols).groupBy(x.alias("x"), F.col(cluster).alias("g")).agg(F.count(F.lit(1)).cast("double").alias("w")))
    both = share >= 1
    asked = points if both else points.where(uniform("silhouette", F.col("x")) < share)
    n, m = points.count(), asked.count()
    lp, rp = max(1, -(-m // QUERY_ROWS), min(ASKED, m // LEAST)), max(1, -(-n // POINT_ROWS))
    sizes = points.groupBy(F.col("g").alias("other")).agg(F.sum("w").alias("size"))
    lp, rp = (max(lp, rp),) * 2 if both else (lp, rp)
    piece = max(1, SUMS // (rp * max(1, sizes.count())))  # points whose sums meet in a task
    right = _blocks(points, rp, p)
    left = right if both else _blocks(asked, lp, p)
    kind = points.schema["g"].dataType.simpleString()
    schema = f"l int, piece int, other {kind}, s binary"

    def opened(table: pa.Table) -> tuple:
        data, w = table.column("x")[0].as_buffer(), np.frombuffer(table.column("w")[0].as_buffer(), float)
        rows = np.frombuffer(data, np.float32 if len(data) < 8 * p * len(w) else float).astype(float).reshape(-1, p)
        names = table.column("g")[0].values.dictionary_encode()
        group = names.indices.fill_null(-1).to_numpy()
        heads = np.flatnonzero(np.diff(group, prepend=-2))
        return rows, w, names.dictionary.take(pa.array([g if g >= 0 else None for g in group[heads]], pa.int32())), np.append(heads, len(w))

    def told(l: int, sums: np.ndarray, names) -> pa.Table:
        starts = range(0, len(sums), piece)
        return pa.table([pa.array([l] * len(starts) * len(names), pa.int32()), pa.array(np.repeat(np.arange(len(starts)), len(names)), pa.int32()),
                         names.take(pa.array(np.tile(np.arange(len(names)), len(starts)))),
                         pa.array([sums[a:a + piece, g].tobytes() for a in starts for g in range(len(names))], pa.binary())], ["l", "piece", "other", "s"])

    def meet(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        l, r = key[0].as_py(), key[1].as_py()
        (xa, wa, names_a, heads_a), (xb, wb, names_b, heads_b) = opened(a), opened(b)
        sums, back = np.zeros((len(xa), len(names_b))), np.zeros((len(xb), len(names_a)))
        serves = both and l != r

        def add(to: np.ndarray, far: np.ndarray, w: np.ndarray, heads: np.ndarray, at: int) -> None:
            """Weighted sums of columns, which are points from ``at`` on, by cluster."""
            end = at + far.shape[1]
            for g in range(np.searchsorted(heads, at, side="right") - 1, np.searchsorted(heads, end)):
                lo, hi = max(heads[g], at), min(heads[g + 1], end)
                to[:, g] += far[:, lo - at:hi - at] @ w[lo:hi]

        high, wide = TILE
        for j in range(0, len(xb), wide):
            distances = distances_to(xb[j:j + wide])
            for i in range(0, len(xa), high):
                far = distances(xa[i:i + high])
                add(sums[i:i + high], far, wb, heads_b, j)
                if serves:
                    add(back[j:j + wide], far.T, wa, heads_a, i)
        out = told(l, sums, names_b)
        return pa.concat_tables([out, told(r, back, names_a)]) if serves else out

    tasks = min(lp * rp, 1000)
    first = left.select(F.col("b").alias("l"), F.explode(F.sequence(F.col("b") if both else F.lit(0), F.lit(rp - 1))).alias("r"), "x", "g", "w")
    second = right.select(F.explode(F.sequence(F.lit(0), F.col("b") if both else F.lit(lp - 1))).alias("l"), F.col("b").alias("r"), "x", "g", "w")
    first, second = (side.toDF("l", "r", "x", "g", "w").repartition(tasks, "l", "r") for side in (first, second))
    met = first.groupBy("l", "r").cogroup(second.groupBy("l", "r")).applyInArrow(
        lambda key, a, b: meet(key, a, b) if a.num_rows and b.num_rows else pa.table(
            [pa.array([], t) for t in (pa.int32(), pa.int32(), (a if a.num_rows else b).schema.field("g").type.value_type, pa.binary())],
            ["l", "piece", "other", "s"]), schema)

    def score(key: tuple, table: pa.Table, block: pa.Table) -> pa.Table:
        at = slice(key[1].as_py() * piece, (key[1].as_py() + 1) * piece)
        w, group = np.frombuffer(block.column("w")[0].as_buffer(), float)[at], block.column("g")[0].values
        total, size = {}, {}
        for other, n, s in zip(table.column("other").to_pylist(), table.column("size").to_pylist(), table.column("s")):
            total[other] = total.get(other, 0) + np.frombuffer(s.as_buffer(), float)
            size[other] = n
        names = group.slice(at.start, len(w)).to_pylist()
        a, b, count = np.full(len(w), np.nan), np.full(len(w), np.inf), np.ones(len(w))
        for g, s in total.items():
            own = np.fromiter((v == g for v in names), bool, len(w))
            b = np.where(own, b, np.minimum(b, s / size[g]))
            a, count = np.where(own, s / max(size[g] - 1, 1), a), np.where(own, size[g], count)
        most = np.maximum(a, b)
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where((count > 1) & (most > 0) & np.isfinite(most), (b - a) / most, 0.0)
        return pa.table([pa.array([float((value * w).sum())]), pa.array([float(w.sum())])], ["v", "w"])

    sums = met.join(F.broadcast(sizes), "other")  # one row a cluster
    whole = left.withColumnRenamed("b", "l").select("l", "g", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("g") - 1) / piece).cast("int"))).alias("piece"))
    spread = min(1000, 4 * lp)
    scored = sums.repartition(spread, "l", "piece").groupBy("l", "piece").cogroup(whole.repartition(spread, "l", "piece").groupBy("l", "piece")).applyInArrow(score, "v double, w double")
    return float(scored.agg(F.sum("v") / F.sum("w")).first()[0])


def fit_pca(df: DataFrame, cols: Sequence[str], k: int = 3):
    """(loadings, variance) frames: (component, feature, loading, mean) and
    (component, explained_ratio, cumulative_ratio).

    Each component's largest absolute loading is made positive.
    """
    spark = df.sparkSession
    rows = df.dropna(subset=list(cols))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(_vectors(rows, cols).select("features"))
    means = rows.agg(*[F.avg(c).alias(c) for c in cols]).first()
    matrix = np.array(model.pc.toArray())
    signs = np.sign(matrix[np.abs(matrix).argmax(axis=0), np.arange(k)])
    matrix = matrix * np.where(signs == 0, 1, signs)
    loadings = spark.createDataFrame(
        [(f"PC{j + 1}", c, float(matrix[i, j]), float(means[c])) for j in range(k) for i, c in enumerate(cols)],
        "component string, feature string, loading double, mean double")
    ratios = spark.createDataFrame(
        [(f"PC{j + 1}", j, float(v)) for j, v in enumerate(model.explainedVariance)],
        "component string, position int, explained_ratio double")
    return loadings, cumulative(ratios, "position", "explained_ratio", "cumulative_ratio").drop("position")


def project(df: DataFrame, loadings: DataFrame) -> DataFrame:
    """Add centred component scores PC1, PC2, ..."""
    parts: dict[str, list] = {}
    for r in loadings.collect():
        parts.setdefault(r["component"], []).append((r["feature"], r["loading"], r["mean"]))
    scores = [
        sum(((F.col(f) - m) * w for f, w, m in terms), F.lit(0.0)).alias(name)
        for name, terms in sorted(parts.items(), key=lambda kv: int(kv[0][2:]))
    ]
    return df.select("*", *scores)


def embedding_columns(df: DataFrame, vector: str, prefix: str = "v") -> tuple[DataFrame, list[str]]:
    """Array column to one double column per position; vectors of different widths are refused, missing ones stay missing."""
    size = F.when(F.col(vector).isNotNull(), F.size(vector))
    narrow, width = df.agg(F.min(size), F.max(size)).first()
    if narrow != width:
        raise ValueError(f"{vector} has vectors of {narrow} to {width} numbers")
    width = width or 0
    names = [f"{prefix}{i}" for i in range(width)]
    return df.select(*[c for c in df.columns if c != vector],
                     *[F.col(vector)[i].cast("double").alias(n) for i, n in enumerate(names)]), names


