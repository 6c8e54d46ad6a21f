"""Isolation forest: hashed samples per tree, trees grown in groups, one scoring pass."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsledger.operators.stats import fitted_row, quantiles
from obsledger.session import cut_lineage

FOREST_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size int, depth int, sample int"


def _average_path(n):
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng, limit: int):
    """Node rows (node, feature, split, left, right, size, depth) of one random tree."""
    rows, todo = [], [(0, np.arange(len(x)), 0)]
    used = 1
    while todo:
        node, idx, depth = todo.pop()
        spans = np.ptp(x[idx], axis=0) if len(idx) else np.zeros(x.shape[1])
        choices = np.flatnonzero(spans > 0)
        if depth >= limit or len(idx) <= 1 or not len(choices):
            rows.append((node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        f = int(rng.choice(choices))
        v = x[idx, f]
        split = float(rng.uniform(v.min(), v.max()))
        go = v <= split
        rows.append((node, f, split, used, used + 1, len(idx), depth))
        todo += [(used, idx[go], depth + 1), (used + 1, idx[~go], depth + 1)]
        used += 2
    return rows


def fit_iforest(df: DataFrame, key: Sequence[str], cols: Sequence[str], trees: int = 100, sample: int = 256,
                seed: int = 42) -> DataFrame:
    """Forest rows, at most trees x (2 * sample - 1).

    A row enters the sample of a tree when its hash for that tree is small; the
    ``sample`` smallest hashes are kept, so the draw depends on the row key only
    and is the same at every size. Rows are copied only for the trees that drew
    them. Each tree is grown from its own at most ``sample`` rows.
    """
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.dropna(subset=list(cols)).select(*key, x.alias("x"))
    n = rows.count()
    wanted = 2 * sample + 64  # drawn per tree before the smallest ``sample`` hashes are kept
    below = int(min(1.0, wanted / max(n, 1)) * (1 << 40))

    def hashed(tree):
        return F.pmod(F.xxhash64(*key, tree, F.lit(seed)), F.lit(1 << 40))

    hits = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: hashed(t) < below)
    drawn = rows.withColumn("tree", F.explode(hits)).withColumn("h", hashed(F.col("tree")))
    order = W.partitionBy("tree").orderBy("h", *key)
    chosen = (drawn.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= sample)
                   .select("tree", "rn", "x"))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf.sort_values("rn")["x"].to_list())
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes = _grow(x, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "depth"])
        return out.assign(tree=tree, sample=len(x))[
            ["tree", "node", "feature", "split", "left", "right", "size", "depth", "sample"]]

    return chosen.groupBy("tree").applyInPandas(grow, FOREST_SCHEMA)


def score_rows(df: DataFrame, forest: DataFrame, cols: Sequence[str], out: str = "raw_score") -> DataFrame:
    """Add the forest's score -2^(-mean path / expected path): nearer to -1 is more isolated.

    The forest is at most trees x 511 small rows; every task walks whole
    batches through all trees. A row with a missing measure gets no score.
    """
    spark = df.sparkSession
    trees = []
    for _, t in forest.toPandas().sort_values(["tree", "node"]).groupby("tree"):
        leaf = t["depth"].to_numpy() + _average_path(t["size"].to_numpy())
        trees.append((t["feature"].to_numpy(), t["split"].to_numpy(), t["left"].to_numpy(), t["right"].to_numpy(),
                      leaf, int(t["sample"].iloc[0])))
    shared = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        m = np.stack(x.to_list()).astype(float)
        total, expected = np.zeros(len(m)), 0.0
        for feature, split, left, right, leaf, size in shared.value:
            at = np.zeros(len(m), dtype=int)
            active = feature[at] >= 0
            while active.any():
                i = np.flatnonzero(active)
                node = at[i]
                go = m[i, feature[node]] <= split[node]
                at[i] = np.where(go, left[node], right[node])
                active[i] = feature[at[i]] >= 0
            total += leaf[at]
            expected += float(_average_path(size))
        return pd.Series(-np.power(2.0, -total / max(expected, 1e-12)))

    x = [F.col(c).cast("double") for c in cols]
    known = F.forall(F.array(*x), lambda v: v.isNotNull() & ~F.isnan(v))
    return df.withColumn(out, F.when(known, score(F.array(*x))))


def detect(df: DataFrame, forest: DataFrame, cols: Sequence[str], contamination: float = 0.05) -> DataFrame:
    """Add ``anomaly_score`` (negative = anomalous) and ``is_anomaly`` for about the share ``contamination``."""
    # the threshold takes a few counting passes: rows are walked through the trees once
    scored = cut_lineage(score_rows(df, forest, cols))
    cut = fitted_row(quantiles(scored, ["raw_score"], [contamination]))["raw_score"][0]
    return (scored.withColumn("anomaly_score", F.col("raw_score") - cut).drop("raw_score")
                  .withColumn("is_anomaly", (F.col("anomaly_score") < 0).cast("int")))
