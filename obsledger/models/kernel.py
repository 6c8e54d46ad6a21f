"""Support-vector regression with an RBF kernel: the exact dual, with its duality gap.

Over few features the kernel of any number of rows is held by the kernel columns of some hundred rows, the landmarks (a pivoted
Cholesky factor, complete up to rounding). Then the dual is solved by an interior-point method: a row keeps its dual values and
slacks, a step sums landmarks x landmarks numbers over all rows, and the number of steps hardly depends on the rows. What the
factor leaves out of each row's kernel is known; it is added to the primal value and taken off the dual one.

Where too many landmarks are needed, or rows are few, the dual is solved by decomposition. Each round takes rows whose dual value is between its bounds
and those that violate the optimum most, at most ``working`` in all, solves their part of the dual, and adds their kernel columns to
the score of every row. Only these rows and their changes travel; the others stay in their partitions with their own dual value and
score. A round costs rows times ``working`` kernel values and the number of rounds grows with the support vectors, so for
very many rows of many features take a share of them or the Fourier features of ``margin``.

Kernel values are never stored, and the sum of dual values stays 0, so the bias is free of penalty. The gap between primal and dual
value bounds how far the model is from the best one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.models.margin import _matrix, numbers
from obsledger.models.scale import fit_scaler, scale
from obsledger.session import cut_lineage

PART = 4_000  # support vectors that meet a block of rows
BLOCK_ROWS = 50_000
SCHEMA = "k long, x array<double>, y double, beta double, f double"
MOST_MARKS = 500  # landmarks; where more are needed, or a tenth of the rows, the dual is solved by decomposition
SMALL_ROWS = 5_000  # up to so many rows the decomposition is quick
LEFT_OUT = 1e-12  # share of a row's kernel beyond the landmarks that makes it one
NEAR = 1e-11  # rows with more beyond the landmarks are scored by all support vectors
STEPS = 100
ROWS_PER_TASK = 25_000  # of the interior-point method, at least
STATE = "x array<double>, y double, s array<double>"


@dataclass(frozen=True)
class Factor:
    """Landmarks and the inverse of their kernel's Cholesky factor: kernel(x, x') is the product of two rows of ``of``."""

    marks: np.ndarray
    inverse: np.ndarray
    gamma: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return _near(x, self.marks, self.gamma) @ self.inverse.T


@dataclass(frozen=True)
class KernelModel:
    """Support vectors (x, beta) on standardised features, bias, and how good the fit is."""

    vectors: DataFrame
    bias: float
    gamma: float
    features: tuple[str, ...]
    scaler: DataFrame
    primal: float
    dual: float
    rounds: int
    converged: bool
    factor: Factor | None = None
    weights: np.ndarray | None = None  # of the factor's columns

    @property
    def gap(self) -> float:
        """How far the primal value is above the dual one, as a share of the primal value."""
        return (self.primal - self.dual) / max(abs(self.primal), 1e-12)


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    squares = (a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(squares, 0.0))


def solve_block(K: np.ndarray, y: np.ndarray, beta: np.ndarray, f: np.ndarray, C: float, eps: float, tol: float,
                most: int = 200_000) -> np.ndarray:
    """Dual values of a working set, its sum kept: of the row that rises best and the one whose fall then gains most, until none gains ``tol``."""
    beta, grad, own = beta.copy(), f - y, np.diag(K).copy()
    for _ in range(most):
        rise = np.where(beta < C, grad + np.where(beta >= 0, eps, -eps), np.inf)  # slope when the value rises
        fall = np.where(beta > -C, grad + np.where(beta > 0, eps, -eps), -np.inf)
        i = int(rise.argmin())
        gains = fall - rise[i]
        if gains.max() <= tol:
            break
        curves = np.maximum(own[i] + own - 2 * K[i], 1e-12)
        j = int(np.where(gains > 0, gains * gains / curves, -1.0).argmax())
        step = min(gains[j] / curves[j], C - beta[i], beta[j] + C)
        if beta[i] < 0:  # the slope changes at 0: stop there
            step = min(step, -beta[i])
        if beta[j] > 0:
            step = min(step, beta[j])
        beta[i] += step
        beta[j] -= step
        grad += step * (K[i] - K[j])
        for at in (i, j):
            if abs(beta[at]) < 1e-12 * C:
                beta[at] = 0.0
    return beta


# ---- landmarks and the interior-point method ------------------------------------------------

def _near(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    """Kernel by differences: few features, no digits lost."""
    squares = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        squares += (a[:, j, None] - b[None, :, j]) ** 2
    return np.exp(-gamma * squares)


def lower(a: np.ndarray) -> np.ndarray | None:
    """Cholesky factor, or None if there is none. Plain loops: threaded LAPACK calls were seen to hang in a driver that runs Spark."""
    a, out = a.copy(), np.zeros_like(a)
    for k in range(len(a)):
        if not a[k, k] > 0:
            return None
        out[k:, k] = a[k:, k] / np.sqrt(a[k, k])
        a[k:, k:] -= out[k:, k, None] * out[None, k:, k]
    return out


def forward(low: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solution of ``low`` x = b, of a vector or a matrix."""
    x = np.array(b, float)
    for i in range(len(low)):
        x[i] = (x[i] - np.einsum("j,j...->...", low[i, :i], x[:i])) / low[i, i]
    return x


def _solve(low: np.ndarray, b: np.ndarray) -> np.ndarray:
    return forward(low.T[::-1, ::-1], forward(low, b)[::-1])[::-1]


def pivots(x: np.ndarray, gamma: float, most: int) -> np.ndarray:
    """Rows of ``x`` whose kernel columns hold the kernel of all of them, the most telling first; at most ``most`` + 1."""
    rest, cols, taken = np.ones(len(x)), np.zeros((min(most + 1, len(x)), len(x))), []
    while len(taken) < len(cols):
        i = int(rest.argmax())
        if rest[i] <= LEFT_OUT:
            break
        k = len(taken)
        cols[k] = (_near(x, x[i:i + 1], gamma)[:, 0] - np.einsum("k,kn->n", cols[:k, i], cols[:k])) / np.sqrt(rest[i])
        rest -= cols[k] ** 2
        rest[i] = 0.0
        taken.append(i)
    return x[taken]


def find_factor(rows: DataFrame, p: int, gamma: float, most: int) -> Factor | None:
    """The factor of the kernel of all rows (column x), or None if it takes more than ``most`` landmarks.

    A task merges the landmarks of its batches, the driver those of the tasks.
    """
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((0, p))
        for b in batches:
            if len(found) <= most:
                found = pivots(np.concatenate([found, np.unique(_matrix(b.column(0), p), axis=0)]), gamma, most)
        yield pa.RecordBatch.from_arrays([numbers(pa.array(list(found), pa.list_(pa.float64())))], ["x"])

    found = np.zeros((0, p))
    for r in rows.select("x").mapInArrow(candidates, "x array<double>").groupBy(F.spark_partition_id()).agg(
            F.sort_array(F.collect_list("x")).alias("x")).orderBy("x").toLocalIterator():
        found = pivots(np.concatenate([found, np.array(r["x"], float)]), gamma, most)
        if len(found) > most:
            return None
    low = lower(_near(found, found, gamma))
    return Factor(found, forward(low, np.eye(len(low))), gamma) if low is not None and len(low) else None


def _totals(rows: DataFrame, per_batch, width: int) -> tuple[np.ndarray, float]:
    """Sums of a vector of ``width`` numbers and the largest of another number over all batches of all tasks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, most = np.zeros(width), 0.0
        for b in batches:
            if b.num_rows:
                more, ratio = per_batch(b)
                sums, most = sums + more, max(most, ratio)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width), pa.int32()), pa.array(np.r_[most, sums])], ["i", "v"])

    out = rows.mapInArrow(task, "i int, v double").groupBy("i").agg(
        F.when(F.col("i") < 0, F.max("v")).otherwise(F.sum("v")).alias("v")).toArrow().sort_by("i").column("v").to_numpy()
    return out[1:], float(out[0])


@dataclass(frozen=True)
class _Interior:
    """Formulas of one batch: V are the distances of both dual values of a row from 0 and C, Z their multipliers."""

    factor: Factor
    C: float
    eps: float

    def read(self, b: pa.RecordBatch):
        x = _matrix(b.column(0), self.factor.marks.shape[1])
        own, y, s = self.factor.of(x), b.column(1).to_numpy(), _matrix(b.column(2), 6).T
        A = np.hstack([own, np.ones((len(x), 1))])
        return A, y, np.stack([s[0], self.C - s[0], s[1], self.C - s[1]]), s[2:]

    def weights(self, V, Z):
        return 1 / (Z[0] / V[0] + Z[1] / V[1]), 1 / (Z[2] / V[2] + Z[3] / V[3])

    def slopes(self, A, y, V, Z, w, m=0.0, E=0.0):
        G, f = (m - V * Z - E) / V, A @ w
        return G, G[0] - G[1] - (f - y + self.eps - Z[0] + Z[1]), G[2] - G[3] - (y - f + self.eps - Z[2] + Z[3])

    def moves(self, A, y, V, Z, w, dw, m=0.0, E=0.0):
        (up, down), (G, g1, g2), along = self.weights(V, Z), self.slopes(A, y, V, Z, w, m, E), A @ dw
        da, dc = up * (g1 - along), down * (g2 + along)
        dV = np.stack([da, -da, dc, -dc])
        return dV, G - Z * dV / V

    def both(self, A, y, V, Z, w, first, dw, m):
        """The corrected move, after the one that aims at the end at once."""
        dV, dZ = self.moves(A, y, V, Z, w, first)
        return self.moves(A, y, V, Z, w, dw, m, dV * dZ)


def _ratio(V, Z, dV, dZ) -> float:
    return float(max((-dV / V).max(), (-dZ / Z).max()))


def fit_factored(rows: DataFrame, factor: Factor, n: int, start: float, spread: float, C: float, eps: float, gap: float):
    """(support vectors, bias, weights, primal, dual, steps) of rows (x, y) by a predictor-corrector interior-point method, or None
    if the gap, with all that the factor leaves out, stays above ``gap``."""
    r, inside = len(factor.marks), _Interior(factor, C, eps)
    q = r + 1
    off = F.lit(start) - F.col("y")
    zs = [F.greatest(side + eps, F.lit(0.0)) + 0.1 * spread for side in (off, -off)]
    state = cut_lineage(rows.select("x", "y", F.array(F.lit(C / 2), F.lit(C / 2), zs[0], zs[0] - (off + eps), zs[1], zs[1] - (eps - off)).alias("s")))
    w, free = np.r_[np.zeros(r), start], np.diag(np.r_[np.ones(r), 0.0])

    def bounds(norm, primal_norm, loss, gain, cost, held, beyond):
        """Primal and dual value, worsened by what is beyond the factor."""
        return (0.5 * (primal_norm + held ** 2) + C * (loss + beyond * held), gain - eps * cost - 0.5 * (norm + held ** 2))

    def certify(A, y, beta, w):
        beyond = np.sqrt(np.maximum(1 - (A[:, :r] ** 2).sum(1), 1e-15))
        return [np.maximum(np.abs(y - A @ w) - eps, 0).sum(), beta @ y, np.abs(beta).sum(), np.abs(beta) @ beyond, beyond.sum()]

    for step in range(STEPS):
        def build(b, w=w):
            A, y, V, Z = inside.read(b)
            (up, down), (_, g1, g2), beta = inside.weights(V, Z), inside.slopes(A, y, V, Z, w), V[0] - V[2]
            return np.concatenate([((A * (up + down)[:, None]).T @ A).ravel(), A.T @ (up * g1 - down * g2), A.T @ beta, certify(A, y, beta, w),
                                   [(V * Z).sum(), (C * C - beta * beta).sum()]]), 0.0

        sums, _ = _totals(state, build, q * q + 2 * q + 7)
        H, rhs, image = sums[:q * q].reshape(q, q) + free, sums[q * q:q * q + q], sums[q * q + q:q * q + 2 * q]
        known, (product, room) = sums[-7:-2], sums[-2:]
        miss = image - np.r_[w[:r], 0.0]
        primal, dual = bounds(image[:r] @ image[:r], w[:r] @ w[:r], *known)
        if not np.isfinite(primal) or not np.isfinite(H).all():
            return None
        if primal - dual <= 0.5 * gap * primal:
            break
        low = lower(H)
        if low is None:
            return None
        first = _solve(low, rhs + miss)

        def predict(b, w=w, first=first):
            A, y, V, Z = inside.read(b)
            dV, dZ = inside.moves(A, y, V, Z, w, first)
            (up, down), E = inside.weights(V, Z), dV * dZ / V
            towards = A.T @ (up * (1 / V[0] - 1 / V[1]) - down * (1 / V[2] - 1 / V[3]))
            back = A.T @ (up * (E[1] - E[0]) - down * (E[3] - E[2]))
            return np.concatenate([towards, back, [(dV * Z + V * dZ).sum(), (dV * dZ).sum()]]), _ratio(V, Z, dV, dZ)

        sums, ratio = _totals(state, predict, 2 * q + 2)
        s = min(1.0, 0.995 / max(ratio, 1e-12))
        m = max((product + s * sums[-2] + s * s * sums[-1]) / product, 0.0) ** 3 * product / (4 * n)
        dw = _solve(low, rhs + miss + m * sums[:q] + sums[q:2 * q])

        def correct(b, w=w, first=first, dw=dw, m=m):
            A, y, V, Z = inside.read(b)
            return np.zeros(0), _ratio(V, Z, *inside.both(A, y, V, Z, w, first, dw, m))

        s = min(1.0, 0.995 / max(_totals(state, correct, 0)[1], 1e-12))
        if s < 1e-6:
            return None

        def go(batches: Iterator[pa.RecordBatch], w=w, first=first, dw=dw, m=m, s=s) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    A, y, V, Z = inside.read(b)
                    dV, dZ = inside.both(A, y, V, Z, w, first, dw, m)
                    V, Z = V + s * dV, Z + s * dZ
                    after = np.stack([V[0], V[2], *Z], 1)
                    lists = pa.ListArray.from_arrays(np.arange(0, 6 * len(y) + 1, 6, dtype=np.int32), after.ravel())
                    yield pa.RecordBatch.from_arrays([numbers(b.column(0)), b.column(1), numbers(lists)], ["x", "y", "s"])

        state = cut_lineage(state.mapInArrow(go, STATE))
        w = w + s * dw
    else:
        return None

    beta = F.col("s")[0] - F.col("s")[1]  # what rounding left of the sum is dealt out to where there is room
    rows = cut_lineage(state.select("x", "y", (beta - float(image[r]) / float(room) * (C * C - beta * beta)).alias("beta")))

    def image_of(b):
        return factor.of(_matrix(b.column(0), factor.marks.shape[1])).T @ b.column(2).to_numpy(), 0.0

    weights, _ = _totals(rows, image_of, r)
    bias = float(w[r])

    def finish(b):
        A = np.hstack([factor.of(_matrix(b.column(0), factor.marks.shape[1])), np.ones((b.num_rows, 1))])
        return np.array(certify(A, b.column(1).to_numpy(), b.column(2).to_numpy(), np.r_[weights, bias])), 0.0

    primal, dual = bounds(weights @ weights, weights @ weights, *_totals(rows, finish, 5)[0])
    if not 0 <= primal - dual <= gap * primal:
        return None
    return rows.select("x", "beta"), bias, weights, float(primal), float(dual), step


# ---- decomposition ----------------------------------------------------------------------------

def _values(rows: DataFrame, C: float, eps: float) -> tuple[float, float, float]:
    """Bias, primal value and dual value of the present dual values."""
    rest = F.col("y") - F.col("f")
    edges = rows.select(F.explode(F.array(rest - eps, rest + eps)).alias("e"))
    bias = edges.agg(F.percentile("e", 0.5)).first()[0] or 0.0  # where the summed losses are least
    norm, loss, cost, gain = rows.agg(
        F.sum(F.col("beta") * F.col("f")), F.sum(F.greatest(F.abs(rest - bias) - eps, F.lit(0.0))),
        F.sum(F.abs("beta")), F.sum(F.col("beta") * F.col("y"))).first()
    norm = norm or 0.0
    return bias, 0.5 * norm + C * (loss or 0.0), (gain or 0.0) - eps * (cost or 0.0) - 0.5 * norm


def fit_kernel_svr(df: DataFrame, features: Sequence[str], target: str, C: float = 100.0, gamma: float = 0.1, eps: float = 0.1,
                   working: int = 1000, tol: float = 1e-3, gap: float = 1e-3, most_rounds: int = 1000) -> KernelModel:
    """Fit on rows that have the target and all features, standardised first.

    Ends when no pair of rows violates the optimum by ``tol`` or the gap is at most ``gap`` of the primal value
    (``converged``), or after ``most_rounds``. A table without rows gives a model of bias 0. More than ``SMALL_ROWS`` rows, at
    least ten times the landmarks, are solved by the interior-point method, to ``gap``; the other parameters are the decomposition's.
    """
    features, p = tuple(features), len(features)
    complete = df.dropna(subset=[*features, target]).select(*[F.col(c).cast("double").alias(c) for c in (*features, target)])
    scaler = fit_scaler(complete, features)
    rows = cut_lineage(scale(complete, scaler).select(
        F.monotonically_increasing_id().alias("k"), F.array(*features).alias("x"), F.col(target).alias("y"), F.lit(0.0).alias("beta"), F.lit(0.0).alias("f")))
    n, mean, spread = rows.agg(F.count(F.lit(1)), F.avg("y"), F.stddev_pop("y")).first()
    most = min(MOST_MARKS, n // 10)
    if n > SMALL_ROWS and spread and np.isfinite(spread):
        data = cut_lineage(rows.select("x", "y").repartition(-(-n // ROWS_PER_TASK)))
        factor = find_factor(data, p, gamma, most)
        solved = fit_factored(data, factor, n, float(mean), float(spread), C, eps, gap) if factor else None
        if solved:
            vectors, bias, weights, primal, dual, rounds = solved
            return KernelModel(vectors, bias, gamma, features, scaler, primal, dual, rounds, True, factor, weights)
    rise = F.when(F.col("beta") < C, F.col("f") - F.col("y") + F.when(F.col("beta") >= 0, eps).otherwise(-eps))
    fall = F.when(F.col("beta") > -C, F.col("f") - F.col("y") + F.when(F.col("beta") > 0, eps).otherwise(-eps))
    converged, rounds, bias, primal, dual = False, 0, 0.0, 0.0, 0.0
    while rounds < most_rounds:
        free = rows.where((F.col("beta") != 0) & (F.abs("beta") < C)).orderBy(F.xxhash64("k", F.lit(rounds))).limit(working // 2).collect()
        side = (working - len(free)) // 2
        up = rows.where(rise.isNotNull()).orderBy(rise.asc(), "k").limit(side)
        down = rows.where(fall.isNotNull()).orderBy(fall.desc(), "k").limit(side)
        held = {r["k"]: r for r in [*free, *up.unionByName(down).collect()]}  # at most ``working`` rows
        if not held:
            converged = True
            break
        ids = sorted(held)
        x, y, beta, f = (np.array([held[k][c] for k in ids], float) for c in ("x", "y", "beta", "f"))
        grad = f - y
        most = (np.where(beta > -C, grad + np.where(beta > 0, eps, -eps), -np.inf).max()
                - np.where(beta < C, grad + np.where(beta >= 0, eps, -eps), np.inf).min())
        if rounds % 2 == 0 or most <= tol:
            bias, primal, dual = _values(rows, C, eps)
            if most <= tol or primal - dual <= gap * max(abs(primal), 1e-12):
                converged = True
                break
        moved = solve_block(kernel(x, x, gamma), y, beta, f, C, eps, max(tol / 2, most * 0.2))
        change = moved - beta
        changed = np.flatnonzero(change)
        if not len(changed):
            break
        at, by, now = x[changed], change[changed], {ids[i]: float(moved[i]) for i in changed}

        def add(batches: Iterator[pa.RecordBatch], at=at, by=by, now=now) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
                score = batch.column(4).to_numpy().copy()
                for a in range(0, len(own), 2000):
                    score[a:a + 2000] += kernel(own[a:a + 2000], at, gamma) @ by
                beta = [now.get(k, b) for k, b in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), numbers(batch.column(1)), batch.column(2), pa.array(beta, pa.float64()), pa.array(score)], ["k", "x", "y", "beta", "f"])

        rows = cut_lineage(rows.mapInArrow(add, SCHEMA))
        rounds += 1
    bias, primal, dual = _values(rows, C, eps)
    vectors = cut_lineage(rows.where("beta <> 0").select("x", "beta"))
    return KernelModel(vectors, float(bias), gamma, features, scaler, float(primal), float(dual), rounds, converged)


def predict_kernel(model: KernelModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Rows with the model's value; rows with a missing feature are left out. Equal feature rows are scored once.

    A model with a factor scores by it all rows of which the landmarks leave nothing out. Otherwise support vectors are dealt into
    parts and rows into blocks; each block meets each part.
    """
    p, gamma = len(model.features), model.gamma
    complete = df.dropna(subset=list(model.features))
    raw = F.array(*[F.col(c).cast("double") for c in model.features])
    keyed = complete.withColumn("_x", raw)
    distinct = scale(keyed.select("_x", *[F.col("_x")[i].alias(c) for i, c in enumerate(model.features)]).distinct(), model.scaler)
    vectors = cut_lineage(distinct.select("_x", F.array(*model.features).alias("z")))
    near = None
    if model.factor is not None:
        factor, weights = model.factor, model.weights

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    own = factor.of(_matrix(b.column(1), p))
                    held = 1 - (own ** 2).sum(1) <= NEAR
                    yield pa.RecordBatch.from_arrays([numbers(b.column(0)), numbers(b.column(1)), pa.array(own @ weights, mask=~held)], ["_x", "z", "s"])

        scored = cut_lineage(vectors.mapInArrow(score, "_x array<double>, z array<double>, s double"))
        near, vectors = scored.where("s IS NOT NULL").select("_x", "s"), scored.where("s IS NULL").select("_x", "z")
        if vectors.isEmpty():
            return keyed.join(near, "_x").select(*df.columns, (F.col("s") + model.bias).alias(out))
    parts = max(1, -(-model.vectors.count() // PART))
    blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    left = vectors.withColumn("block", F.pmod(F.xxhash64("_x"), F.lit(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = model.vectors.withColumn("part", F.pmod(F.xxhash64("x", "beta"), F.lit(parts)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        z = a.column("z").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
        sums = np.zeros(len(z))
        if b.num_rows and len(z):
            x, beta = b.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, p), b.column("beta").to_numpy()
            for at in range(0, len(z), 2000):
                sums[at:at + 2000] = kernel(z[at:at + 2000], x, gamma) @ beta
        return pa.table([numbers(a.column("_x")), pa.array(sums)], ["_x", "s"])

    sums = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(meet, "_x array<double>, s double")
    sums = sums if near is None else near.unionByName(sums)
    scores = sums.groupBy("_x").agg(F.sum("s").alias("_s"))
    return keyed.join(scores, "_x").select(*df.columns, (F.col("_s") + model.bias).alias(out))
