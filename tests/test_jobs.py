"""Files, tables, forecasts, synthetic rows, streams and whole jobs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from obsledger.functions.scalars import parse_date
from obsledger.models import horizons as H
from obsledger.models import regress
from obsledger.operators import catalogue as K
from obsledger.operators import publish as U
from obsledger.operators import synth as Y
from obsledger.operators.evaluate import timed
from obsledger.operators.reshape import nest_forecast, unnest_forecast
from obsledger.plans import forecast, patterns, prepare, regression, report, risk
from obsledger.queries.forecasts import _HISTORY, STATION
from obsledger.queries.frames import daily, metric_rows
from obsledger.roles import METRIC_SCHEMA, OBSERVATION_SCHEMA, WEATHER
from obsledger.sources import commits, files, tables


# ---- files and tables -----------------------------------------------------------------

def test_csv_round_trip_with_missing_marks(spark, weather, tmp_path):
    path = str(tmp_path / "obs")
    weather.fillna("NA").write.option("header", True).option("nullValue", "NA").csv(path)
    back = files.read_observations(spark, path)
    assert back.schema == OBSERVATION_SCHEMA and back.count() == weather.count()
    assert back.where("MinTemp IS NULL").count() == weather.where("MinTemp IS NULL").count()
    assert dict(files.read_observations(spark, path, schema=None).dtypes)["MinTemp"] == "double"


def test_parquet_json_and_versions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 3), (2, "b", 7), (3, "c", 7)], "id int, t string, version int")
    files.write_table(df, str(tmp_path / "p"), partition_by=["version"])
    latest = files.read_latest(spark, str(tmp_path / "p"))
    assert sorted(r["id"] for r in latest.collect()) == [2, 3]
    assert latest.columns == df.columns and len(latest.inputFiles()) < len(spark.read.parquet(str(tmp_path / "p")).inputFiles())
    files.write_table(df.withColumn("version", F.concat(F.lit("v 0"), F.col("version"))), str(tmp_path / "q"), partition_by=["version"])
    assert {r["version"] for r in files.read_latest(spark, str(tmp_path / "q")).collect()} == {"v 07"}
    files.write_doc(df, str(tmp_path / "j"))
    assert files.read_doc(spark, str(tmp_path / "j"), df.schema).exceptAll(df).isEmpty()
    files.write_table(df, str(tmp_path / "c"), "csv")
    assert files.read_table(spark, str(tmp_path / "c"), "csv", None).columns == df.columns


def test_append_and_read_metrics(spark, sf):
    spark.sql("DROP TABLE IF EXISTS metrics_test")
    rows = spark.createDataFrame([("r1", "svm", "r2", 0.8)], METRIC_SCHEMA)
    tables.append_table(rows, "metrics_test")
    tables.append_table(rows.withColumn("run_id", F.lit("r2")), "metrics_test")
    stored = tables.query(spark, "SELECT * FROM metrics_test WHERE run_id = :r", r="r2")
    assert stored.count() == 1 and K.runs(spark.table("metrics_test")).count() == 2
    assert "metrics_test" in [r[0] for r in K.result_tables(spark).collect()]


def test_models_survive_saving(spark, sf, tmp_path):
    rows = daily(spark, sf)
    model = regress.fit_regressor(rows, ["top"], "total")
    files.save_model(model, str(tmp_path / "m"))
    again = files.load_model(str(tmp_path / "m"))
    a, b = regress.predict(model, rows), regress.predict(again, rows)
    assert a.exceptAll(b).isEmpty()
    files.save_model(regress.coefficients(model, spark), str(tmp_path / "w"))
    assert files.load_params(spark, str(tmp_path / "w")).count() == 2


def test_dashboard_extracts(spark, sf, tmp_path):
    reg, cls = metric_rows(spark, sf)
    paths = files.export_extracts({"regression": reg, "classification": cls}, str(tmp_path))
    assert spark.read.option("header", True).csv(paths[0]).columns == ["run_id", "model_name", "metric", "value"]


# ---- forecasts ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def trained(spark, sf):
    rows = daily(spark, sf)
    return forecast.train(rows, STATION, ["total", "top"], range_of=("total", "top"), max_iter=3)


def test_sequence_beyond_the_last_horizon_repeats_it(trained):
    models, rows, _, _ = trained
    last = forecast.latest_rows(rows, STATION)
    out = forecast.forecast_entities(models, last, STATION, ["total", "top"], days=5).toPandas()
    three, five = (out[out["Day"] == d].sort_values("station").reset_index(drop=True) for d in (3, 5))
    assert (three["total"] == five["total"]).all()
    assert set(out["rain_forecast"]) <= {"Yes", "No"} and out["rain_probability"].between(0, 1).all()
    gap = out["forecast_date"].map(lambda d: d.toordinal()) - out["d"].map(lambda d: d.toordinal())
    assert (gap == out["Day"]).all()


def test_wide_scores_and_targets(trained):
    models, rows, _, _ = trained
    wide = H.predict_wide(rows, models, ["station", "d"])
    assert set(models.targets()) == set(wide.columns) - {"station", "d"} and len(models.targets()) == 9
    assert models.seconds > 0


def test_on_demand_days_are_limited(trained):
    models, rows, _, _ = trained
    fields = {"max_temp": "total"}
    with pytest.raises(ValueError):
        forecast.on_demand(models, rows, STATION, ["total"], fields, days=4)
    one = forecast.on_demand(models, rows, STATION, ["total"], fields, days=2, location=rows.first()["station"])
    assert one.count() == 1 and len(one.first()["days"]) == 2


def test_fit_ignores_absent_label_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert H.rain_history(df, "RainToday").first()["rain_day_3"] == 0
    assert H.scoring_rows(df, ["f_a"]).columns == ["a", "f_a"]


def test_store_and_read_the_latest_forecast(spark):
    spark.sql("DROP TABLE IF EXISTS forecasts_test")
    flat = spark.createDataFrame([("Sydney", dt.date(2025, 1, d), 10.04 * d, 20.0, None if d == 2 else "Yes") for d in (2, 1, 3)],
                                 "city string, d date, lo double, hi double, rain string")
    nested = nest_forecast(flat, "city", "d", {"min_temp": "lo", "max_temp": "hi"}, "rain")
    assert [x["date"] for x in nested.first()["days"]] == ["2025-01-01", "2025-01-02", "2025-01-03"]
    assert tables.save_forecast(nested, "forecasts_test") == 3
    assert tables.save_forecast(nested, "forecasts_test", "second") == 3
    stored = spark.table("forecasts_test")
    assert len(stored.columns) == 17 and stored.count() == 6
    view = U.stored_view(stored, "Sydney")
    assert view.first()["forecast_id"] == "second" and view.count() == 1
    days = unnest_forecast(view).orderBy("date").collect()
    assert [r["min_temp"] for r in days] == [10.0, 20.1, 30.1] and days[1]["rain_forecast"] == "Unknown"
    doc = json.loads(U.forecast_document(nested, 3).first()["document"])
    assert doc["n_predictions"] == 3 and doc["location"] == "Sydney"
    assert U.api_form(nested, 3).first()["status"] == "success"
    assert U.document_view(nested).count() == 1 and U.document_view(nested, "Nowhere").isEmpty()


def test_location_view_defaults(spark, weather):
    rows = weather.withColumn("Date", parse_date("Date", lenient=True))
    fields = {"temperature_max": "MaxTemp", "temperature_min": "MinTemp", "humidity": "Humidity3pm",
              "precipitation": "Rainfall", "wind_speed": "Absent", "sunshine": "Sunshine"}
    known = U.location_view(rows, WEATHER, fields, "Perth").collect()
    assert len(known) == 3 and known[0]["state"] == "WA" and known[0]["wind_speed"] == 15.0
    fallback = U.location_view(rows, WEATHER, fields, "Atlantis").first()
    assert fallback["location"] == "Sydney" and fallback["state"] == "NSW"


def test_locations_all_when_none_match(spark):
    dim = U.places(spark)
    some = spark.createDataFrame([("perth",), ("perth",), ("x",)], "Location string")
    assert [r["name"] for r in U.forecast_locations(some, "Location", dim, "name").collect()] == ["Perth"]
    assert U.forecast_locations(some.where("Location = 'x'"), "Location", dim, "name").count() == 8


# ---- synthetic rows ----------------------------------------------------------------------

def test_synthetic_days(spark, sf):
    rows = daily(spark, sf)
    a = Y.synthetic_days(rows, STATION, 10, "2025-01-05")
    assert sorted(r["d"] for r in a.collect()) == [dt.date(2025, 1, 5) + dt.timedelta(days=i) for i in range(10)]
    b = Y.synthetic_days(rows.repartition(3), STATION, 10, "2025-01-05")
    assert a.select("d", F.round("total", 6)).exceptAll(b.select("d", F.round("total", 6))).isEmpty()
    with pytest.raises(ValueError):
        Y.synthetic_days(rows, STATION, 3, "2025-07-01")


def test_synthetic_days_complete_categories(spark, sf):
    rows = daily(spark, sf).withColumn("rain_today", F.when(F.col("top") > 50, F.col("rain_today")))
    assert Y.synthetic_days(rows, STATION, 12, "2025-01-01").where("rain_today IS NULL").isEmpty()


def test_coherent_sequences(spark, sf):
    rows = daily(spark, sf).withColumn("rain_tomorrow", F.when(F.col("top") > 100, "Yes").otherwise("No"))
    out = Y.coherent_sequences(rows, _HISTORY, ["total", "top"], start="2025-01-01", length=4)
    stations = rows.select("station").distinct().count()
    assert out.count() == 4 * stations
    by_day = {(r["station"], r["day"]): r for r in out.collect()}
    assert all(r["rain_today"] == by_day[s, d - 1]["rain_tomorrow"] for (s, d), r in by_day.items() if d > 0)
    assert all(r["d"] == dt.date(2025, 1, 1) + dt.timedelta(days=d) for (s, d), r in by_day.items())
    one = Y.coherent_sequences(rows, _HISTORY, ["total"], entities=[rows.first()["station"], -1], start="2025-01-01")
    assert one.count() == 3  # the unknown entity is skipped
    with pytest.raises(ValueError):
        Y.coherent_sequences(rows, _HISTORY, ["total"], entities=[-1], start="2025-01-01")


def test_sequences_start_today_by_default(spark, sf):
    rows = daily(spark, sf).withColumn("rain_tomorrow", F.lit("No"))
    assert Y.coherent_sequences(rows, _HISTORY, ["total"], length=1).agg(F.min("d") == F.current_date()).first()[0]


# ---- whole jobs ------------------------------------------------------------------------------

def test_regression_family(spark, sf):
    rows = daily(spark, sf)
    out = regression.run_regressions(rows, ["top", "n_events"], "total", ["station", "d"], "r1",
                                     params={"forest": {"trees": 5}, "tree": {"max_depth": 6}})
    r2 = {r["model_name"]: r["value"] for r in out.where("metric = 'r2'").collect()}
    assert set(r2) == {"LinearRegression", "DecisionTreeRegressor", "RandomForestRegressor", "SVM"}
    assert all(v > 0.5 for v in r2.values())
    names = {(r["model_name"], r["metric"]): r["value"] for r in out.collect()}
    for model in r2:
        assert names[model, "rows_scored"] > 0 and names[model, "model_size"] > 0
        assert names[model, "training_time_seconds"] > 0 and names[model, "prediction_time_seconds"] > 0
    assert len(names) == out.count() == 4 * 8


def test_forest_risk_and_bayes(spark, sf):
    rows = daily(spark, sf).withColumn("rain_tomorrow", F.when(F.col("total") > 150, "Yes").otherwise("No"))
    ready = regress.with_calendar(rows, "d")
    metrics, index, model = risk.forest_risk(ready, _HISTORY, ["total", "top"], "r1", trees=5)
    timing = {"training_time_seconds", "prediction_time_seconds", "rows_scored", "model_size"}
    assert {r["metric"] for r in metrics.collect()} == {"accuracy", "precision", "recall", "f1"} | timing
    assert index.count() == rows.select("station").distinct().count()
    assert index.agg(F.min("climate_risk_index"), F.max("climate_risk_index")).first()[0] >= 0
    params, scores, scored = risk.bayes_next_day(daily(spark, sf).withColumn("k", F.lit(1)), STATION, "r1", "k")
    assert params.count() == 2 and not scored.isEmpty()
    found = {r["metric"]: r["value"] for r in scores.collect()}
    assert {"accuracy", "precision_rain", "recall_no_rain", "f1_rain", "f1"} | timing <= set(found)
    assert found["rows_scored"] == scored.count() and found["f1"] == found["f1_rain"]


def test_bayes_on_the_weather_table(spark, weather):
    rows = weather.withColumn("Date", parse_date("Date", lenient=True)).dropna(subset=["Date"])
    given = risk.bayes_rows(rows, WEATHER, use_given_label=True)
    assert given.where("label IS NULL").isEmpty() and given.count() == rows.count()
    joined = risk.bayes_rows(rows, WEATHER)
    assert 0 < joined.count() < rows.count()


def test_patterns_job(spark, sf):
    rows = daily(spark, sf).withColumn("key", F.xxhash64("station", "d"))
    scaled = prepare.cluster_input(rows, ["total", "top"], ["key"])
    found = patterns.find_patterns(scaled, "key", ["total", "top"], k=2, eps=0.3, components=2, restarts=1, trees=10)
    n = rows.count()
    assert all(found[x].count() == n for x in ("kmeans", "dbscan", "pca", "isolation"))
    assert found["kmeans_insights"].count() == 4 and found["cross_insights"].count() == 2
    assert found["pca_insights"].count() == 4
    metrics = {(r["model_name"], r["metric"]): r["value"] for r in found["metrics"].collect()}
    noise = found["dbscan"].where("dbscan_cluster = -1").count()
    assert metrics["DBSCAN", "n_noise_points"] == noise and abs(metrics["DBSCAN", "noise_percentage"] - 100 * noise / n) < 1e-9
    assert metrics["DBSCAN", "n_clusters"] == found["dbscan"].where("dbscan_cluster >= 0").select("dbscan_cluster").distinct().count()
    assert metrics["IsolationForest", "n_anomalies"] == found["isolation"].where("is_anomaly = 1").count()
    assert metrics["KMeans", "inertia"] > 0 and -1 <= metrics["KMeans", "silhouette_score"] <= 1
    assert abs(metrics["KMeans", "inertia"] - found["kmeans"].agg(F.sum("distance2")).first()[0]) < 1e-6 * metrics["KMeans", "inertia"]
    assert {m for m, name in metrics if name == "training_time_seconds"} == {"KMeans", "DBSCAN", "PCA", "IsolationForest"}


def test_report_job(spark, sf):
    reg, cls = metric_rows(spark, sf)
    one = lambda df, m: df.where(f"model_name = '{m}' AND run_id = 'run_1997'")
    summary = report.summarise({"svm": one(reg, "model1"), "ols": one(reg, "model2")}, {"bayes": one(cls, "model3")})
    assert summary["summary"].where("type = 'regression'").first()["n_models"] == 2
    assert [r["rank"] for r in summary["ranking"].orderBy("rank").collect()] == [1, 2]
    assert summary["best_classifier"].first()["model_name"] == "bayes" and summary["series"].count() == 2
    rows = spark.createDataFrame([(0, 1.0, 5.0, 0), (0, 2.0, 5.5, 0), (1, 9.0, 1.0, 1)], "cluster int, a double, b double, odd int")
    from obsledger.operators import insight
    found = {"kmeans_insights": insight.cluster_insights(rows, "cluster", ["a", "b"]),
             "isolation_insights": insight.contrast_insights(rows, "odd", ["a", "b"])}
    assert report.as_document(report.report(summary, found)).count() == 4


def test_timed_metric():
    value, row = timed(lambda: 7, "training_time", "r1", "svm")
    assert value == 7 and row[:3] == ("r1", "svm", "training_time") and row[3] >= 0


def test_stream_scores_new_files_once(spark, sf, tmp_path):
    from obsledger.models import bayes
    from obsledger.streaming.scoring import arriving, score_arriving

    rows = daily(spark, sf).withColumn("y", (F.col("rain_today") == "Yes").cast("int"))
    params = bayes.fit_bayes(rows, ["total", "top"], "y")
    rows.limit(20).coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        q = score_arriving(arriving(spark, str(tmp_path / "in"), rows.schema), params, ["total", "top"], str(tmp_path / "out"))
        q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_forecast_job_is_metered(spark, sf):
    rows = daily(spark, sf)
    (models, featured, features, codes), metrics = forecast.metered_train(rows, STATION, ["total"], "r9")
    found = {r["metric"]: r["value"] for r in metrics.collect()}
    assert set(found) == {"training_time_seconds", "prediction_time_seconds", "rows_scored", "n_models", "model_size"}
    assert found["rows_scored"] == featured.count() and found["n_models"] == 3


def test_rows_are_stored_once(spark, tmp_path):
    path, schema = str(tmp_path / "results"), "a int, b string"
    rows = spark.createDataFrame([(1, "x"), (2, None)], schema)
    assert commits.read_committed(spark, path, schema).count() == 0
    assert commits.append_once(rows, path, "run 1") and not commits.append_once(rows, path, "run 1")
    assert commits.append_once(rows.limit(1), path, "run 2")
    read = lambda: sorted(map(tuple, commits.read_committed(spark, path, schema).collect()), key=str)
    want = [(1, "x", "run 1"), (1, "x", "run 2"), (2, None, "run 1")]
    assert read() == want
    lost = commits.stage(rows, path)  # a step that ended before it was published
    assert read() == want
    late = commits.stage(rows, path)  # two attempts of one key, side by side
    commits.publish(spark, path, "run 3", lost)
    commits.publish(spark, path, "run 3", late)
    assert read() == sorted([*want, (1, "x", "run 3"), (2, None, "run 3")], key=str)
    assert commits.commits(spark, path).where("key = 'run 3'").first()["attempt"] == lost


def test_draws_have_one_plan_for_any_length(spark, sf):
    rows = daily(spark, sf).withColumn("rain_tomorrow", F.lit("No"))
    short, long = (Y.coherent_sequences(rows, _HISTORY, ["total"], start="2024-01-01", length=n) for n in (3, 40))
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(short) == size(long)
    counts = long.groupBy("station").count().collect()
    assert all(r["count"] == 40 for r in counts)
    again = Y.coherent_sequences(rows.repartition(7), _HISTORY, ["total"], start="2024-01-01", length=40)
    same = lambda df: df.withColumns({c: F.round(c, 6) for c in ("total", "top")})
    assert same(long).exceptAll(same(again)).isEmpty()
