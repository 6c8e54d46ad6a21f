import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsledger.functions import scalars as S
from obsledger.operators import catalogue as K
from obsledger.operators import clean as C
from obsledger.operators import insight, profile
from obsledger.operators import reshape as R
from obsledger.operators import stats
from obsledger.plans import prepare


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ---- quantiles and modes ---------------------------------------------------------

@pytest.mark.parametrize("limit", [0, 3, 50])
def test_rank_search_equals_percentile(spark, limit):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 7 == 0, 5.0).otherwise(F.pow(F.lit(1.07), (F.col("id") * 37 % 101).cast("double")) - 50).alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("b"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    want = stats.quantiles(df, ["a", "b"], probs, ["g"], max_distinct=10**6)
    got = stats.quantiles(df, ["a", "b"], probs, ["g"], max_distinct=limit)
    for x, y in zip(rows(want, "g"), rows(got, "g")):
        assert x[0] == y[0]
        assert x[1] == pytest.approx(y[1]) and x[2] == pytest.approx(y[2])


@pytest.mark.parametrize("max_rows", [0, 2, 10**6])
def test_narrowed_brackets_equal_percentile(spark, max_rows):
    df = spark.range(700).repartition(5).select(
        F.when(F.col("id") % 3 > 0, 4.25).otherwise((F.col("id") * 37 % 101).cast("double") / 7 - 5).alias("a"),
        F.when(F.col("id") % 5 > 0, F.exp((F.col("id") % 60).cast("double"))).alias("b"),
        F.lit(None).cast("double").alias("none"), F.lit(3.0).alias("same"))
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    want = df.agg(*[F.percentile(c, F.array(*map(F.lit, probs))) for c in df.columns]).first()
    got = stats.quantiles(df, df.columns, probs, max_rows=max_rows).first()
    for c, w, g in zip(df.columns, want, got):
        assert (g == [None] * 6) if c == "none" else (g == pytest.approx(w)), c


def test_heavy_value_beside_an_outlier(spark):
    df = spark.createDataFrame([(1.0,)] * 300 + [(2.0,), (3.0,), (1e300,), (-1e300,)], "x double")
    got = stats.quantiles(df, ["x"], [0.0, 0.5, 0.99, 1.0], max_rows=1).first()[0]
    assert got == pytest.approx(df.agg(F.percentile("x", F.array(*map(F.lit, [0.0, 0.5, 0.99, 1.0])))).first()[0])


def test_mode_tie_takes_smallest_and_ignores_missing(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", "z"), (None, None)], "x string, y string")
    assert tuple(stats.modes(df, ["x", "y"]).first()) == ("a", "z")


def test_quantile_is_linear(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x double")
    assert stats.quantiles(df, ["x"], [0.25, 0.5]).first()[0] == [1.75, 2.5]


# ---- cleaning ---------------------------------------------------------------------

def test_impute_leaves_no_gap_and_keeps_values(spark, weather):
    out = C.impute(weather, ["MinTemp", "MaxTemp"], "median")
    assert out.where("MinTemp IS NULL OR MaxTemp IS NULL").isEmpty()
    same = out.alias("o").join(weather.alias("w"), ["Location", "Date", "Rainfall", "RainToday"])
    assert same.where("w.MinTemp IS NOT NULL AND o.MinTemp <> w.MinTemp").isEmpty()


def test_impute_same_on_any_partitioning(spark, weather):
    a = C.impute(weather.repartition(1), ["MinTemp", "Rainfall"], "median")
    b = C.impute(weather.repartition(7), ["MinTemp", "Rainfall"], "median")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_fit_on_train_only(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    train = spark.createDataFrame([(10.0,), (20.0,)], "x double")
    assert rows(C.impute(df, ["x"], "mean", fit_on=train), "x") == [(1.0,), (3.0,), (15.0,)]


def test_mode_fallback_when_all_missing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x string")
    assert rows(C.impute(df, ["x"], "mode", fallback="Unknown"), "x") == [("Unknown",), ("Unknown",)]


def test_random_fill_is_stable_and_observed(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.col("id") % 3)).alias("c"))
    a = C.impute_random(df, "c", ["id"]).orderBy("id").collect()
    b = C.impute_random(df.repartition(5), "c", ["id"]).orderBy("id").collect()
    assert a == b and {r["c"] for r in a} == {"v0", "v1", "v2"}


def test_random_fill_with_many_categories(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 4 > 0, F.when(F.col("id") % 3 == 0, "often").otherwise(
        F.concat(F.lit("v"), F.col("id") % 50))).alias("c"))
    out = C.impute_random(df, "c", ["id"])
    assert out.count() == 3000 and out.where("c IS NULL").isEmpty()
    assert out.join(df.where("c IS NOT NULL"), ["id", "c"]).count() == df.where("c IS NOT NULL").count()
    assert 0.25 < out.where("id % 4 = 0").agg(F.avg((F.col("c") == "often").cast("double"))).first()[0] < 0.42
    again = C.impute_random(df.repartition(5), "c", ["id"])
    assert out.exceptAll(again).isEmpty()


def test_clip_and_flag(spark, weather):
    hi = C.iqr_bounds(weather, ["Rainfall"]).first()["Rainfall"]["upper"]
    clipped = C.clip_upper(weather, ["Rainfall"])
    assert clipped.agg(F.max("Rainfall")).first()[0] == pytest.approx(hi)
    flagged = C.flag_outliers(weather, ["Rainfall"])
    assert flagged.where("Rainfall_Outlier = 1").select("Rainfall").collect()[0][0] == 300.0
    assert flagged.where("Rainfall IS NULL").select("Rainfall_Outlier").first()[0] == 0


def test_constant_column_has_no_outlier(spark, weather):
    assert C.outlier_counts(weather, ["Cloud9am"]).first()["n_outliers"] == 0


def test_dedup_columns_and_kinds(spark):
    df = spark.range(2).select("id", F.lit("x").alias("a"), F.lit(1.5).alias("id"))
    out = C.dedup_columns(df)
    assert out.columns == ["id", "a"] and out.dtypes[0][1] == "bigint"
    assert profile.columns_of(out, "numeric") == ["id"] and profile.columns_of(out, "text") == ["a"]


def test_month_filter_raises_when_empty(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),)], "d date")
    with pytest.raises(ValueError):
        C.filter_month(df, "d", 5, require=True)
    assert C.filter_month(df, "d", 3, require=True).count() == 1


def test_one_hot_refuses_wide_columns(spark):
    with pytest.raises(ValueError):
        C.categories(spark.range(20).select(F.col("id").cast("string").alias("c")), "c", limit=10)


def test_one_hot_index_numbers_any_width(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, F.format_string("v%05d", F.col("id") % 1500)).alias("c"))
    out = C.one_hot_index(df, "c", "place")
    assert out.columns == ["id", "c", "place"] and out.count() == 3000
    names = sorted({r["c"] for r in df.collect() if r["c"]})
    assert all(r["place"] == (names.index(r["c"]) if r["c"] else None) for r in out.collect())


def test_default_calendar_uses_date_when_there(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),)], "Date date")
    assert rows(C.default_calendar(df), "Date") == [(dt.date(2024, 3, 1), 3, 61)]


# ---- scalars ------------------------------------------------------------------------

def test_strict_date_raises_lenient_gives_missing(spark):
    df = spark.createDataFrame([("2024-02-01",), ("nope",)], "t string")
    assert rows(df.select(S.parse_date("t", lenient=True).alias("d")), F.col("d").desc()) == [(dt.date(2024, 2, 1),), (None,)]
    with pytest.raises(Exception):
        df.select(S.parse_date("t")).collect()


def test_lenient_number(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("NaN",), ("",), ("null",), ("x1",), (None,), ("-2",)], "t string")
    got = [r[0] for r in df.select(S.lenient_double("t", 9.0)).collect()]
    assert got == [1.5, 9.0, 9.0, 9.0, 9.0, 9.0, -2.0]


def test_seasons_and_week_start(spark):
    df = spark.createDataFrame([(1,), (4,), (7,), (10,), (None,)], "m int")
    assert [r[0] for r in df.select(S.season("m", "en")).collect()] == ["Summer", "Autumn", "Winter", "Spring", "Unknown"]
    assert [r[0] for r in df.select(S.season("m", "es")).collect()] == ["Verano", "Otoño", "Invierno", "Primavera", "Primavera"]
    monday = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date")
    assert monday.select(S.calendar_part("d", "day_of_week")).first()[0] == 0


def test_rules(spark):
    df = spark.createDataFrame([("Yes", 9.0), ("No", 9.0), ("No", 7.0), ("No", None)], "r string, s double")
    assert [r[0] for r in df.select(S.weather_condition("r", "s")).collect()] == ["Rainy", "Sunny", "Partly Cloudy", "Sunny"]
    p = spark.createDataFrame([(0.5,), (0.51,), (None,)], "p double")
    assert [r[0] for r in p.select(S.rain_label("p")).collect()] == ["No", "Yes", None]
    g = spark.createDataFrame([(0.8,), (0.6,), (0.4,), (0.2,), (0.1,)], "x double")
    assert [r[0] for r in g.select(S.grade_r2("x")).collect()] == ["excelente", "bueno", "moderado", "débil", "muy limitado"]


def test_default_run_id(spark):
    df = spark.createDataFrame([("r1",), ("",), (None,)], "r string")
    got = [r[0] for r in df.select(S.default_run_id("r", "NaiveBayes")).collect()]
    assert got[0] == "r1" and got[1].startswith("NaiveBayes_") and got[2].startswith("NaiveBayes_")


def test_hashed_normal_has_unit_spread(spark):
    r = spark.range(20000).select(S.normal(F.col("id"), 7).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(r[0]) < 0.03 and abs(r[1] - 1) < 0.03


# ---- reshape, catalogue, findings -------------------------------------------------------

def test_melt_and_concat(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    hot = C.one_hot(df, "c")
    assert rows(R.melt_onehot(hot, "c_", ["id"], "c"), "id") == [(1, "a"), (2, "b")]
    both = R.concat_rows(df, spark.createDataFrame([(9,)], "id int"))
    assert both.count() == 4 and both.where("id = 9").first()["c"] is None


def test_run_registry_and_settings(spark):
    r = K.new_run(spark, "nightly").first()
    assert len(r["run_id"]) == 36 and r["description"] == "nightly"
    assert K.model_settings(spark, "SVM").count() == 3 and K.model_settings(spark, "Forest").count() == 0


def test_pick_document(spark):
    df = spark.createDataFrame([("m", None, [0.5])], "model string, coef array<double>, feature_importances array<double>")
    out = K.pick_document(df, K.IMPORTANCE_KEYS, "feature_importance")
    assert out.columns == ["model", "feature_importance"] and out.first()[1] == [0.5]


def test_extra_alias_names_are_known(spark):
    df = spark.createDataFrame([("r", "NaiveBayes", "f1_rain", 0.57), ("r", "NaiveBayes", "NaiveBayes_recall", 0.5)],
                               "run_id string, model_name string, metric string, value double")
    got = dict(rows(K.canonical_metrics(df, K.CLASSIFICATION_METRICS).select("metric", "value"), "metric"))
    assert got == {"f1": 0.57, "recall": 0.5}


def test_comparison_report(spark):
    ranked = spark.createDataFrame([("ols", 0.81, 9.7, 1, 81.0, "excelente")],
                                   "model_name string, r2 double, mse double, rank int, explained_pct double, grade string")
    cls = spark.createDataFrame([("nb", 0.57, 0.82, 0.57, 0.57, 0.57, "buena", "balanced")],
                                "model_name string, score double, accuracy double, precision double, recall double, f1 double, grade string, balance string")
    df = spark.createDataFrame([(0, 1.0, 5.0, 0), (0, 2.0, 5.5, 0), (1, 9.0, 1.0, 1)], "cluster int, a double, b double, odd int")
    report = insight.comparison_report(ranked, cls, insight.cluster_insights(df, "cluster", ["a", "b"]),
                                       insight.contrast_insights(df, "odd", ["a", "b"]))
    text = {r["section"]: r["line"] for r in report.collect()}
    assert set(text) == {"mejor_modelo_regresion", "clasificacion", "patrones_climaticos", "anomalias_climaticas"}
    assert "81.00%" in text["mejor_modelo_regresion"]


# ---- cleaning chains ---------------------------------------------------------------------

def test_column_counts_of_the_chains(spark, weather):
    assert len(weather.columns) == 24
    out = prepare.risk_features(weather)
    assert len(out.columns) == 31 and out.count() == weather.count()
    final = prepare.clean_table(weather.where("Date <> 'not a date'"))
    assert final.columns[:2] == ["Location", "Date"] and len(final.columns) == 25
    assert final.where(" OR ".join(f"`{c}` IS NULL" for c in final.columns)).isEmpty()
    scaled = prepare.cluster_input(final)
    s = scaled.agg(F.avg("MaxTemp"), F.stddev_pop("MaxTemp")).first()
    assert abs(s[0]) < 1e-9 and abs(s[1] - 1) < 1e-9
