"""Density clusters in many dimensions against the sequential algorithm."""

import numpy as np
import pytest

from obsledger.models import density, pivots


def sequential(x, eps, least):
    """Labels of the plain algorithm; a border point takes the least number among its core neighbours."""
    squares = np.zeros((len(x), len(x)))
    for k in range(x.shape[1]):
        squares += (x[:, None, k] - x[None, :, k]) ** 2
    near = squares <= eps * eps
    core, label, number = near.sum(1) >= least, np.full(len(x), -1), 0
    for i in np.flatnonzero(core):
        if label[i] < 0:
            todo, label[i] = [i], number
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core):
                    if label[j] < 0:
                        label[j] = number
                        todo.append(j)
            number += 1
    for i in np.flatnonzero(~core & (near & core).any(1)):
        label[i] = label[near[i] & core].min()
    return label


def shapes():
    rng, p = np.random.default_rng(0), 14
    centres = rng.normal(size=(8, p)) * 1.5
    yield "blobs", np.concatenate([c + rng.normal(size=(60, p)) * 0.12 for c in centres] + [rng.normal(size=(150, p))])
    line = np.zeros((600, p))
    line[:, 0], line[:, 1] = np.linspace(0, 20, 600), rng.normal(size=600) * 0.05
    line[300:] += 0.6
    yield "two lines of many units", line.round(2)
    yield "copies and distances of exactly eps", np.concatenate(
        [np.zeros((30, p)), (rng.normal(size=(400, p)) * 0.15).round(2), rng.integers(0, 2, (150, p)) * 0.5])
    yield "five dimensions", rng.normal(size=(600, 5)) * 0.6


CASES = [(x, True) for _, x in shapes()] + [(next(shapes())[1], False)]


@pytest.mark.parametrize("x, small", CASES, ids=[*(n for n, _ in shapes()), "blobs, few pivots"])
def test_labels_equal_the_sequential_ones(spark, monkeypatch, x, small):
    if small:  # many pivots, and blocks that part every cell
        for key, value in (("POINTS_PER_PIVOT", 20), ("BLOCK", 40), ("SAMPLED", 2)):
            monkeypatch.setattr(pivots, key, value)
    cols = [f"c{k}" for k in range(x.shape[1])]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in cols))
    got = density.dbscan(df, "id", cols, 0.5, 5).orderBy("id").toPandas()
    assert (got["dbscan_cluster"].to_numpy() == sequential(x, 0.5, 5)).all()
    assert ((got["dbscan_cluster"] == -1) == (got["is_anomaly"] == 1)).all()


def test_within_decides_ties_exactly():
    a = np.array([[0.0, 0.0], [1e8, 1e8]])
    i, j = pivots.within(a, np.array([[0.3, 0.4], [1e8 + 3, 1e8 + 4], [0.3, 0.4000001]]), 0.5)
    assert (0.3 * 0.3 + 0.4 * 0.4 <= 0.25) == (0 in j) and 2 not in j
    assert list(pivots.within(a, np.array([[1e8 + 3, 1e8 + 4]]), 5.0)[0]) == [1]


def test_unparted_points_give_back_less_than_their_pairs(spark, monkeypatch):
    """Directions in 40 dimensions, where no cell is out of reach: tasks give back a number or a link a point, never visits or pairs."""
    monkeypatch.setattr(pivots, "POINTS_PER_PIVOT", 20)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 40))
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    points = spark.createDataFrame([(i, 1, r.tolist()) for i, r in enumerate(x)], "pid long, w long, x array<double>")
    placed = pivots.place(points, 1.3, 5, 40)
    blocks = placed.points.select("block").distinct().count()
    near = (((x[:, None] - x[None]) ** 2).sum(2) <= 1.3 ** 2)
    assert near.sum() > 50 * len(x) and len(placed.pivots) == 45
    core = pivots.core_points(placed, 5)
    assert {r["pid"] for r in core.collect()} == set(np.flatnonzero(near.sum(1) >= 5).tolist())
    links = pivots.core_links(placed, placed.points.join(core, "pid", "left_semi"))
    assert placed.n_pairs <= blocks * (blocks + 1) / 2 and links.count() <= len(x) * blocks


def test_missing_numbers_are_noise_and_leave_the_others_alone(spark):
    x = next(shapes())[1]
    cols = [f"c{k}" for k in range(x.shape[1])]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    odd = [(1000, *[None] * x.shape[1]), (1001, float("nan"), *[0.0] * (x.shape[1] - 1)), (1002, float("inf"), *[0.0] * (x.shape[1] - 1))]
    df = spark.createDataFrame(rows + odd, "id long, " + ", ".join(f"{c} double" for c in cols))
    got = density.dbscan(df, "id", cols, 0.5, 5).orderBy("id").toPandas()["dbscan_cluster"].to_numpy()
    assert (got == np.append(sequential(x, 0.5, 5), [-1] * 3)).all()


def test_no_rows(spark):
    cols = [f"c{k}" for k in range(5)]
    empty = spark.createDataFrame([], "id long, " + ", ".join(f"{c} double" for c in cols))
    assert density.dbscan(empty, "id", cols).count() == 0


def test_candidates_grow_with_the_points(spark):
    """Ten times the points: visits to cells a point stay about the same, as pivots grow along."""
    shares = []
    for n in (2_000, 20_000):
        rng = np.random.default_rng(3)
        x = rng.normal(size=(40, 14))[rng.integers(0, 40, n)] + rng.normal(size=(n, 14)) * 0.2
        pivot = x[rng.choice(n, n // pivots.POINTS_PER_PIVOT, replace=False)]
        far = pivots._distances(x, pivot)
        home = far.argmin(1)
        reach = np.array([far[home == k, k].max() if (home == k).any() else -np.inf for k in range(len(pivot))])
        between = pivots._distances(pivot, pivot)
        own = far.min(1)[:, None]
        seen = (far ** 2 - own ** 2 <= 2 * 0.5 * between[home]) & (far <= reach + 0.5)
        shares.append((seen * np.bincount(home, minlength=len(pivot))).sum() / n ** 2)  # share of all pairs that is compared
    assert shares[1] < shares[0]
