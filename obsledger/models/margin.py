"""Linear support-vector regression and classification for many targets at once.

One feature matrix serves all targets: every iteration is one Spark job that
returns the loss and gradient of each target, summed over the tasks. A target
missing on a row has no weight there. Only the weights (targets x features)
live on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.models.scale import fit_scaler, scale, scaler_values
from obsledger.session import cut_lineage

ROWS_PER_TASK = 50_000
SMALL_PARTS = 64
# Rows and numbers of packed blocks that one task passes over: a task costs about 0.1 s however few they are.
MOST_ROWS = 250_000
MOST_CELLS = 6_000_000
BLOCK_ROWS = 5_000
PIECE_ROWS = 2_000
FEW_WEIGHTS = 16
# Smoothing of the loss corner in target standard deviations, coarse to fine.
SMOOTHING = (2.0, 0.8, 0.3, 0.1, 0.03)
WEIGHT_SCHEMA = "target string, kind string, feature string, weight double, mean double, std double"


NUMBERS = pa.list_(pa.field("element", pa.float64()))


def numbers(column):
    """An Arrow list column whose elements may be missing, as schemas written as text have it."""
    return column.cast(NUMBERS)


def _matrix(column, width: int) -> np.ndarray:
    """Arrow list column to a rows x width matrix, missing numbers as nan."""
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return chunk.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _loss(margin: np.ndarray, y: np.ndarray, kind: str, eps: float, mu: float):
    """Smoothed loss and its slope per row and target; 0 where the target is missing."""
    if kind == "hinge":
        direction = np.where(y > 0, -1.0, 1.0)
        over = np.where(np.isnan(y), -1.0, 1.0 + direction * margin)
    else:
        r = margin - y
        over, direction = np.abs(r) - eps, np.copysign(1.0, r)
    over = np.fmax(over / mu, 0.0)  # a missing number gives 0
    share = np.minimum(over, 1.0)
    return (over - share / 2) * (share * mu), share * direction, (share > 0) & (share < 1)


def _curve(x: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """XX' over the marked rows of each target; ``x`` is weights x rows, ``marked`` targets x rows."""
    q, t = len(x), len(marked)
    if q > FEW_WEIGHTS:
        return np.stack([x[:, m] @ x[:, m].T for m in marked])
    # all targets in one product of matrices, over the products of two weights
    pairs = [(i, j) for i in range(q) for j in range(i, q)]
    both = np.empty((len(pairs), x.shape[1]))
    for k, (i, j) in enumerate(pairs):
        np.multiply(x[i], x[j], out=both[k])
    i, j = np.array(pairs).T
    out = np.empty((t, q, q))
    out[:, i, j] = out[:, j, i] = marked.astype(float) @ both.T
    return out


def _sideways(x: np.ndarray, y: np.ndarray):
    """A block in pieces that stay in the cache, turned to weights x rows (with the bias) and targets x rows."""
    for at in range(0, len(x), PIECE_ROWS):
        part = x[at:at + PIECE_ROWS]
        yield np.concatenate([part.T, np.ones((1, len(part)))]), np.ascontiguousarray(y[at:at + PIECE_ROWS].T)


def sum_batches(rows: DataFrame, per_batch, width: int) -> np.ndarray:
    """Sum a vector of ``width`` numbers over all Arrow batches of all tasks.

    Every task adds its batches up first; the vectors of the tasks are summed
    by a grouped aggregate, so the driver receives ``width`` numbers.
    """
    def task(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += per_batch(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total)], names=["i", "v"])

    out = np.zeros(width)
    for r in rows.mapInArrow(task, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def packed(df: DataFrame, widths: Sequence[int], n: int, labels: bool = False) -> DataFrame:
    """Keep the list columns of about ``n`` rows at hand for the rounds of a fit, as blocks of their bytes.

    A round then hands whole blocks to the tasks, without turning every row
    into Arrow again. A task gets about MOST_ROWS rows, fewer if they are wide. With
    ``labels`` the last column holds 0/1 labels, kept as one byte each.
    """
    schema = ", ".join(f"m{i} binary" for i in range(len(widths)))

    def table(blocks):
        return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in blocks], names=[f"m{i}" for i in range(len(widths))])

    def pack(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                found = [_matrix(part.column(i), w) for i, w in enumerate(widths)]
                if labels:
                    found[-1] = np.where(np.isnan(found[-1]), -1, found[-1] > 0).astype(np.int8)
                yield table([m.tobytes() for m in found])

    def merge(batches):
        held, size = [], 0
        for b in batches:
            for k in range(b.num_rows):
                held.append([c[k].as_py() for c in b.columns])
                size += len(held[-1][0])
                if size >= BLOCK_ROWS * widths[0] * 8:
                    yield table([b"".join(v) for v in zip(*held)])
                    held, size = [], 0
        if held:
            yield table([b"".join(v) for v in zip(*held)])

    parts = max(1, -(-n // max(1, min(MOST_ROWS, MOST_CELLS // sum(widths)))))
    return df.mapInArrow(pack, schema).repartition(parts).mapInArrow(merge, schema).persist(StorageLevel.MEMORY_AND_DISK)


def _blocks(batch, widths: Sequence[int], labels: bool = False):
    """The matrices of each packed block of an Arrow batch."""
    for k in range(batch.num_rows):
        kinds = [float] * (len(widths) - 1) + [np.int8 if labels else float]
        found = [np.frombuffer(c[k].as_buffer(), d).reshape(-1, w) for c, d, w in zip(batch.columns, kinds, widths)]
        if labels:
            found[-1] = np.where(found[-1] < 0, np.nan, found[-1])
        yield found


class _Objective:
    """Loss and gradient of 0.5|w|^2 + C * sum(loss), divided by the rows of the target."""

    def __init__(self, rows: DataFrame, p: int, t: int, kind: str, C: float, eps: float):
        self.rows, self.p, self.t, self.kind, self.C, self.eps = rows, p, t, kind, C, eps

    def moments(self):
        """Per target: rows, X'X and X'y over the rows that have it (least-squares start)."""
        p, t, labels = self.p, self.t, self.kind == "hinge"

        def per_piece(x, y):
            have = ~np.isnan(y)
            return np.concatenate([have.sum(1), _curve(x, have).ravel(), (np.where(have, y, 0.0) @ x.T).ravel()])

        q = p + 1
        flat = sum_batches(self.rows, lambda b: sum(per_piece(*m) for block in _blocks(b, (p, t), labels) for m in _sideways(*block)), t + t * q * q + t * q)
        return flat[:t], flat[t:t + t * q * q].reshape(t, q, q), flat[t + t * q * q:].reshape(t, q)

    def evaluate(self, W: np.ndarray, n: np.ndarray, mu: float, live: np.ndarray | None = None):
        """Value, gradient and curvature of every target from one job; only of those marked ``live``, if given (else infinite, 0, 0)."""
        p, width, kind, eps = self.p, self.t, self.kind, self.eps
        asked = np.arange(width) if live is None else np.flatnonzero(live)
        q, t, V = p + 1, len(asked), W[asked]

        def per_piece(x, y):
            value, slope, bent = _loss(V @ x, y if live is None else y[asked], kind, eps, mu)
            return np.concatenate([value.sum(1), (slope @ x.T).ravel(), (_curve(x, bent) / mu).ravel()])

        flat = sum_batches(self.rows, lambda b: sum(per_piece(*m) for block in _blocks(b, (p, width), kind == "hinge") for m in _sideways(*block)), t + t * q + t * q * q)
        free = np.diag([1.0] * p + [0.0])  # the bias carries no penalty
        f, g, h = np.full(width, np.inf), np.zeros((width, q)), np.zeros((width, q, q))
        f[asked] = 0.5 * (V[:, :p] ** 2).sum(1) + self.C * flat[:t]
        g[asked] = V @ free + self.C * flat[t:t + t * q].reshape(t, q)
        h[asked] = free + self.C * flat[t + t * q:].reshape(t, q, q)
        return f / n, g / n[:, None], h / n[:, None, None]


def _minimise(obj: _Objective, W: np.ndarray, n: np.ndarray, size: np.ndarray, mus, max_iter: int,
              tol: float) -> np.ndarray:
    """Damped Newton for all targets together, with a smoothing that shrinks in steps.

    ``size`` is the curvature of each weight if every row counted. A share of it
    is added to the curvature of a target whose last step went wrong. A target
    that stops improving is left as it is while the others go on.
    """
    damping = np.full(len(n), 1e-3)
    for mu in mus:
        f, g, h = obj.evaluate(W, n, mu)
        live = np.ones(len(f), dtype=bool)
        for _ in range(max_iter):
            extra = damping[:, None] * (size / mu + 1e-12)
            d = -np.stack([np.linalg.solve(a + np.diag(e), b) for a, e, b in zip(h, extra, g)])
            W2 = np.where(live[:, None], W + d, W)
            f2, g2, h2 = obj.evaluate(W2, n, mu, live)
            took = live & (f2 <= f)
            better = f - f2 > tol * np.maximum(np.abs(f), 1e-12)
            damping = np.where(live, np.where(took, np.maximum(damping / 10, 1e-8), np.maximum(damping * 30, 1e-4)), damping)
            W, g, h = (np.where(took.reshape(-1, *[1] * (v.ndim - 1)), v2, v) for v, v2 in ((W, W2), (g, g2), (h, h2)))
            f = np.where(took, f2, f)
            live &= np.where(took, better, damping < 1e3)
            if not live.any():
                break
        damping = np.clip(damping, 1e-3, 1.0)
    return W


def _resident(df: DataFrame, n: int) -> DataFrame:
    """Keep rows at hand for the rounds of a fit.

    A small frame is first gathered into as many parts as its rows call for;
    a large one stays spread as it is, without another shuffle.
    """
    parts = max(1, -(-n // ROWS_PER_TASK))
    rows = df.repartition(parts) if parts <= SMALL_PARTS else df
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


def fit_margin(df: DataFrame, features: Sequence[str], targets: Sequence[str], kind: str = "eps",
               C: float = 1.0, eps: float = 0.1, scaled: bool = True, max_iter: int = 8,
               tol: float = 1e-4) -> DataFrame:
    """Weight rows (target, feature, weight, mean, std) of linear models with an unpenalised bias.

    ``kind="eps"`` is epsilon-insensitive regression, ``kind="hinge"`` a
    classifier of 0/1 targets. Rows with a missing feature are left out; a
    target without rows (or a 0/1 target with one class) gets no model.
    """
    spark, p, t = df.sparkSession, len(features), len(targets)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in (*features, *targets)]).dropna(subset=list(features))
    seen = rows.agg(*[F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                               F.stddev_pop(c).alias("sd")).alias(c) for c in targets]).first()
    usable = [c for c in targets if seen[c]["n"] > 0 and (kind == "eps" or seen[c]["lo"] < seen[c]["hi"])]
    if not usable:
        return spark.createDataFrame([], WEIGHT_SCHEMA)
    t = len(usable)
    fitted = fit_scaler(rows, features)
    centre = scaler_values(fitted) if scaled else {c: (0.0, 1.0) for c in features}
    x = scale(rows, fitted) if scaled else rows
    most = max(seen[c]["n"] for c in usable)
    data = packed(x.select(F.array(*features).alias("x"), F.array(*usable).alias("y")), (p, t), most, kind == "hinge")
    try:
        obj = _Objective(data, p, t, kind, C, eps)
        n, gram, xy = obj.moments()
        ridge = np.diag([1.0] * p + [0.0])
        W = np.stack([np.linalg.lstsq(gram[i] + ridge, xy[i], rcond=None)[0] for i in range(t)])
        if kind == "eps":
            spread = max(float(np.median([seen[c]["sd"] or 1.0 for c in usable])), 1e-9)
        else:  # least squares on labels -1 and 1
            W, spread = 2 * W - np.eye(p + 1)[p], 1.0
        size = obj.C * np.einsum("tii->ti", gram) / np.maximum(n, 1)[:, None]
        W = _minimise(obj, W, n, size, [spread * m for m in SMOOTHING], max_iter, tol)
    finally:
        data.unpersist()
    out = [
        (name, kind, f, float(W[i, j]), *map(float, centre[f]))
        for i, name in enumerate(usable) for j, f in enumerate(features)
    ] + [(name, kind, "(bias)", float(W[i, p]), 0.0, 1.0) for i, name in enumerate(usable)]
    return spark.createDataFrame(out, WEIGHT_SCHEMA)


def fit_svr(df, features, target, C=1.0, eps=0.1, scaled=False, **kw) -> DataFrame:
    """Linear epsilon-SVR of one target on unscaled features."""
    return fit_margin(df, features, [target], "eps", C, eps, scaled, **kw)


def weights_of(weights: DataFrame) -> dict[str, dict]:
    """Weights as {target: {"kind", "bias", "terms": [(feature, weight, mean, std)]}}; a few numbers per target."""
    out: dict[str, dict] = {}
    for r in weights.collect():
        m = out.setdefault(r["target"], {"kind": r["kind"], "bias": 0.0, "terms": []})
        if r["feature"] == "(bias)":
            m["bias"] = r["weight"]
        else:
            m["terms"].append((r["feature"], r["weight"], r["mean"], r["std"]))
    return out


def margin_column(model: dict):
    """Linear score of one fitted target; a missing feature counts as 0."""
    out = F.lit(model["bias"])
    for f, w, mean, std in model["terms"]:
        out = out + (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - mean) / std * w
    return out


def predict_margin(df: DataFrame, weights: DataFrame, suffix: str = "") -> DataFrame:
    """Add one score column per fitted target, named after it."""
    models = weights_of(weights)
    return df.select("*", *[margin_column(m).alias(f"{t}{suffix}") for t, m in models.items()])


# ---- kernel approximation ---------------------------------------------------------------

def fourier_features(df: DataFrame, cols: Sequence[str], gamma: float = 0.1, n: int = 64, seed: int = 42):
    """(frame, names): random Fourier features whose inner product approximates exp(-gamma |a-b|^2)."""
    rng = np.random.default_rng(seed)
    omega = rng.normal(0.0, np.sqrt(2 * gamma), (n, len(cols)))
    phase = rng.uniform(0, 2 * np.pi, n)
    names = [f"rff_{i}" for i in range(n)]
    adds = []
    for i, name in enumerate(names):
        angle = F.lit(float(phase[i]))
        for j, c in enumerate(cols):
            angle = angle + F.col(c) * float(omega[i, j])
        adds.append((F.cos(angle) * float(np.sqrt(2.0 / n))).alias(name))
    return df.select("*", *adds), names


def fit_kernel_svr(df: DataFrame, features: Sequence[str], target: str, C: float = 100.0, gamma: float = 0.1,
                   eps: float = 0.1, n_features: int = 64, seed: int = 42, **kw):
    """RBF-kernel SVR: standardise on the training rows, random Fourier features, linear SVR.

    Returns a scoring function frame -> frame with ``prediction``.
    """
    fitted = fit_scaler(df, features)

    def expand(rows):
        return fourier_features(scale(rows, fitted), features, gamma, n_features, seed)

    wide, names = expand(df.dropna(subset=[*features, target]))
    weights = fit_margin(wide, names, [target], "eps", C, eps, scaled=False, **kw)
    model = weights_of(weights)[target]

    def score(rows: DataFrame) -> DataFrame:
        wide, names = expand(rows)
        return wide.withColumn("prediction", margin_column(model)).drop(*names)

    return score


# ---- probabilities ------------------------------------------------------------------------

def fit_platt(df: DataFrame, pairs: Sequence[tuple[str, str]], rounds: int = 30) -> dict[str, tuple[float, float]]:
    """Sigmoid (a, b) per (margin column, 0/1 label): P = 1 / (1 + exp(a * margin + b)).

    Newton steps on slightly softened labels; every round is one job over all pairs.
    """
    t = len(pairs)
    counts = df.agg(*[F.count_if(F.col(y) == v).alias(f"{v}{i}") for i, (_, y) in enumerate(pairs) for v in (1, 0)]).first()
    pos = np.array([counts[f"1{i}"] for i in range(t)], dtype=float)
    neg = np.array([counts[f"0{i}"] for i in range(t)], dtype=float)
    high, low = (pos + 1) / (pos + 2), 1 / (neg + 2)
    rows = packed(df.select(F.array(*[F.col(m).cast("double") for m, _ in pairs]).alias("m"),
                            F.array(*[F.col(y).cast("double") for _, y in pairs]).alias("y")), (t, t), int((pos + neg).max()))
    a, b = np.full(t, -1.0), np.log((neg + 1) / (pos + 1))
    a = np.where(pos * neg > 0, a, 0.0)

    def moments(a, b):
        def per_block(x, y):
            seen = ~np.isnan(y)
            p = 1 / (1 + np.exp(np.clip(x * a + b, -35, 35)))
            gap = np.where(seen, np.where(y > 0, high, low) - p, 0.0)
            curve = np.where(seen, p * (1 - p), 0.0)
            return np.concatenate([(gap * x).sum(0), gap.sum(0), (curve * x * x).sum(0), (curve * x).sum(0), curve.sum(0)])
        return sum_batches(rows, lambda b: sum(per_block(*m) for m in _blocks(b, (t, t))), 5 * t).reshape(5, t)

    for _ in range(rounds):
        ga, gb, haa, hab, hbb = moments(a, b)
        det = (haa + 1e-9) * (hbb + 1e-9) - hab * hab
        da = np.clip(((hbb + 1e-9) * ga - hab * gb) / det, -5, 5)
        db = np.clip(((haa + 1e-9) * gb - hab * ga) / det, -5, 5)
        a, b = a - da, b - db
        if max(np.abs(da).max(), np.abs(db).max()) < 1e-6:
            break
    rows.unpersist()
    return {m: (float(a[i]), float(b[i])) for i, (m, _) in enumerate(pairs)}


def platt_column(margin, ab: tuple[float, float]):
    return 1 / (1 + F.exp(F.least(F.greatest(margin * ab[0] + ab[1], F.lit(-35.0)), F.lit(35.0))))


def fit_classifier(df: DataFrame, features: Sequence[str], labels: Sequence[str], C: float = 1.0, folds: int = 5, **kw):
    """(weights, platt) of linear classifiers with probabilities for one or more 0/1 labels.

    The sigmoid is fitted on margins of rows that the model behind them has not seen: rows are dealt into ``folds`` by a hash of
    their features, and one joint fit serves the whole models and those without each fold. A fold whose other rows have
    one class only takes the whole model; ``folds`` of 1 takes it for all rows.
    """
    rows = df.dropna(subset=list(features))
    fold = F.pmod(F.xxhash64(*[F.col(c).cast("double") for c in features]), F.lit(folds))
    taken, without = {c.lower() for c in df.columns}, {}
    for label in labels:
        for k in range(folds if folds > 1 else 0):
            name = f"{label}_without_{k}"
            while name.lower() in taken:
                name = f"_{name}"
            without[label, k] = name
    masked = rows.select("*", *[F.when(fold != k, F.col(label)).alias(name) for (label, k), name in without.items()])
    fitted = cut_lineage(fit_margin(masked, features, [*labels, *without.values()], "hinge", C, scaled=True, **kw))
    weights = fitted.where(F.col("target").isin(*labels))
    every = weights_of(fitted)
    models = {t: every[t] for t in labels if t in every}
    if not models:
        return weights, {}
    unseen = []
    for t, model in models.items():
        margin = margin_column(model)
        for k in range(folds if folds > 1 else 0):
            if without[t, k] in every:
                margin = F.when(fold == k, margin_column(every[without[t, k]])).otherwise(margin)
        unseen.append(margin.alias(f"_m_{t}"))
    scored = rows.select(*models, *unseen)
    platt = fit_platt(scored, [(f"_m_{t}", t) for t in models])
    return weights, {t: platt[f"_m_{t}"] for t in models}


def predict_classifier(df: DataFrame, weights: DataFrame, platt: dict, out: str = "{}_probability") -> DataFrame:
    """Add P(1) per fitted label."""
    models = weights_of(weights)
    return df.select("*", *[platt_column(margin_column(m), platt[t]).alias(out.format(t)) for t, m in models.items()])


