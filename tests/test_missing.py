"""Missing group keys, NaN and infinities, missing measures."""

import math

import pytest
from pyspark.sql import functions as F

from obsledger.models.bayes import fit_bayes, predict_bayes
from obsledger.models.clusters import assign, embedding_columns
from obsledger.models.density import dbscan
from obsledger.models.isolation import detect, fit_iforest
from obsledger.operators.aggregate import composite_risk
from obsledger.operators.profile import quantiles_by
from obsledger.operators.stats import quantiles
from obsledger.operators.timeline import rank_by


@pytest.mark.parametrize("odd", [math.nan, math.inf, -math.inf])
def test_quantiles_end_on_odd_values(spark, odd):
    frame = spark.createDataFrame([(float(k),) for k in range(40)] + [(odd,)], "v double")
    (q,) = quantiles(frame, ["v"], [0.0, 0.5, 1.0], max_rows=5).first()
    assert q == ([0.0, 19.5, 39.0] if math.isnan(odd) else [0.0, 20.0, odd] if odd > 0 else [odd, 19.0, 39.0])


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_grouped_quantiles_keep_groups(spark, limit):
    rows = [("a", float(k)) for k in range(9)] + [(None, float(k)) for k in range(5)] + [("n", None), ("n", math.nan)]
    got = {r.g: r.v for r in quantiles(spark.createDataFrame(rows, "g string, v double"), ["v"], [0.5], ["g"], max_distinct=limit).collect()}
    assert got["a"] == [4.0] and got[None] == [2.0] and got["n"] in (None, [None]) and len(got) == 3


def test_missing_groups_are_groups(spark):
    frame = spark.createDataFrame([("e1", None, 1.0), ("e2", None, 3.0), ("e1", "s", 2.0), ("e2", "s", 5.0)], "e string, g string, v double")
    assert {(r.e, r.g): r.rank for r in rank_by(frame, "v", by="g").collect()} == {
        ("e1", None): 2, ("e2", None): 1, ("e1", "s"): 2, ("e2", "s"): 1}
    assert composite_risk(frame, "e", {"v": 1.0}, by="g").count() == 4
    assert {r.g: r.n for r in quantiles_by(frame, ["g"], "v", [0.5]).collect()} == {None: 2, "s": 2}


def test_rows_without_a_measure_have_no_cluster(spark):
    frame = spark.createDataFrame([(None, 2.0), (1.0, 1.0)], "x double, y double")
    centres = spark.createDataFrame([(0, 0.0, 0.0), (1, 9.0, 9.0)], "cluster int, x double, y double")
    assert [r.cluster for r in assign(frame, centres, ["x", "y"]).orderBy("y").collect()] == [0, None]


def test_density_keeps_a_column_named_x(spark):
    frame = spark.createDataFrame([(k, float(k % 3) / 10, 0.0) for k in range(12)], "id long, x double, y double")
    out = dbscan(frame, "id", ["x", "y"])
    assert {"id", "x", "y"} <= set(out.columns) and out.where(F.col("x").isNull()).count() == 0


@pytest.mark.parametrize("entities", [1, 2, 12])
def test_sequences_of_any_number_of_entities(spark, entities):
    import datetime

    from obsledger.operators.synth import coherent_sequences
    from obsledger.roles import Roles
    first = datetime.date(2024, 1, 1)
    rows = [(f"s{e}", first + datetime.timedelta(days=d), 1000.0 + d if (d + e) % 5 else None, "Yes" if d % 2 else "No", "No" if d % 3 else "Yes")
            for e in range(entities) for d in range(30)]
    frame = spark.createDataFrame(rows, "e string, d date, v double, today string, label string")
    roles = Roles(entity="e", date="d", key=(), measures=("v",), categoricals=("today", "label"), today="today", label="label")
    out = coherent_sequences(frame, roles, ["v"], start="2024-01-10", length=4).collect()
    assert len(out) == 4 * entities and all(r.v is None or 900 < r.v < 1200 for r in out)
    by = {(r.e, r.day): r for r in out}
    assert all(by[e, d].today == by[e, d - 1].label for e, d in by if d and by[e, d - 1].label)


def test_vectors_of_different_widths_are_refused(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [1.0, 2.0, 3.0])], "id long, v array<double>")
    with pytest.raises(ValueError):
        embedding_columns(frame, "v")
    wide, names = embedding_columns(frame.where("id < 3"), "v")
    assert names == ["v0", "v1"] and wide.where("v0 IS NULL").count() == 1


def test_bayes_without_classes_or_spread(spark):
    frame = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "x double, y int")
    got = predict_bayes(frame, fit_bayes(frame, ["x"], "y"), ["x"]).first()
    assert got["probability"] == pytest.approx(2 / 3) and got["prediction"] == 1
    nothing = predict_bayes(frame, fit_bayes(frame.where("y > 1"), ["x"], "y"), ["x"]).first()
    assert nothing["probability"] is None and nothing["prediction"] is None


def test_forest_leaves_rows_without_measures_unscored(spark):
    frame = spark.range(500).select("id", F.when(F.col("id") != 7, F.rand(1)).alias("x"), F.rand(2).alias("y"))
    out = detect(frame, fit_iforest(frame, ["id"], ["x", "y"], trees=10, sample=32), ["x", "y"]).collect()
    assert len(out) == 500 and [r["id"] for r in out if r["is_anomaly"] is None] == [7]
