"""Forecast features, views, documents and synthetic rows over the daily table."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.models import horizons as H
from obsledger.operators import publish as U
from obsledger.operators import synth as Y
from obsledger.operators.reshape import nest_forecast, unnest_forecast
from obsledger.operators.timeline import first_n
from obsledger.plans import forecast as plan
from obsledger.queries import query
from obsledger.queries.frames import DAILY, DAY_MEASURES, daily, rounded, table
from obsledger.roles import Roles

STATION = Roles(entity="station", date="d", measures=tuple(DAY_MEASURES), categoricals=("rain_today",), today="rain_today")

_PICKED = [f"f_{c}" for c in ("Month", "DayOfYear", *DAY_MEASURES, "Range", "EntityCode")]


@query("forecast_features", f"""WITH {DAILY}, g AS (SELECT station, d, CASE WHEN n_events > 3 THEN NULL ELSE top END AS top, total, n_events FROM daily
  WHERE station IN (3, 7, 11, 20, 33, 41, 57, 60)),
c AS (SELECT station, CAST(row_number() OVER (ORDER BY station) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT station FROM g)),
m AS (SELECT avg(top) AS top, avg(total - top) AS spread FROM g)
SELECT g.station, g.d, CAST(month(g.d) AS DOUBLE) AS "f_Month", CAST(dayofyear(g.d) AS DOUBLE) AS "f_DayOfYear", round(g.total, 4) AS f_total,
  round(coalesce(g.top, m.top), 4) AS f_top, g.n_events AS f_n_events, round(coalesce(g.total - g.top, m.spread), 4) AS "f_Range",
  c.code AS "f_EntityCode" FROM g JOIN c USING (station), m""")
def forecast_features(spark, sf_dir):
    eight = [3, 7, 11, 20, 33, 41, 57, 60]
    rows = daily(spark, sf_dir).withColumn("top", F.when(F.col("n_events") <= 3, F.col("top")))
    codes = H.entity_codes(rows.where(F.col("station").isin(*eight)), "station")
    out, _ = H.forecast_features(rows, STATION, eight, ("total", "top"), codes)
    return rounded(out.select("station", "d", *_PICKED), "f_total", "f_top", "f_Range")


@query("rain_history", f"""WITH {DAILY} SELECT station, d, CASE WHEN rain_today = 'Yes' THEN 1 ELSE 0 END AS rain_day_1,
  CASE WHEN rain_today = 'Yes' THEN 1 ELSE 0 END AS rain_day_2, CASE WHEN rain_today = 'Yes' THEN 1 ELSE 0 END AS rain_day_3 FROM daily""")
def rain_history(spark, sf_dir):
    return H.rain_history(daily(spark, sf_dir).select("station", "d", "rain_today"), "rain_today").drop("rain_today")


_VIEW = """v AS (SELECT station, d, rn, total, top, n_events, rain_today FROM (
  SELECT *, row_number() OVER (PARTITION BY station ORDER BY d) AS rn FROM daily WHERE station = (SELECT CASE WHEN count(*) > 0 THEN {wanted} ELSE 9 END FROM daily WHERE station = {wanted})) WHERE rn <= 3)
SELECT CAST(v.station AS VARCHAR) AS location, strftime(v.d, '%Y-%m-%d') AS date, v.total AS temperature_max, v.top AS temperature_min,
  CAST(60 AS DOUBLE) AS humidity, round(v.n_events * 3, 4) AS precipitation_score, CAST(15 AS DOUBLE) AS wind_speed,
  CASE WHEN v.rain_today = 'Yes' THEN 'Rainy' WHEN v.top > 7 THEN 'Sunny' ELSE 'Partly Cloudy' END AS weather_condition,
  coalesce(n.n_name, 'nowhere') AS n_name FROM v LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS nk, n_name FROM nation) n ON n.nk = CAST(v.station AS VARCHAR)"""


def _view(spark, sf_dir, location):
    fields = {"temperature_max": "total", "temperature_min": "top", "precipitation": "n_events", "sunshine": "top"}
    dim = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("nk"), "n_name")
    out = U.location_view(daily(spark, sf_dir), STATION, fields, location, 9, 3, dim, "nk", ["n_name"], {"n_name": "nowhere"})
    return rounded(out, "precipitation_score")


@query("latest_location_view", f"WITH {DAILY}, " + _VIEW.format(wanted=17))
def latest_location_view(spark, sf_dir):
    return _view(spark, sf_dir, 17)


@query("unknown_location_view", f"WITH {DAILY}, " + _VIEW.format(wanted=-5))
def unknown_location_view(spark, sf_dir):
    return _view(spark, sf_dir, -5)


@query("location_index", f"""WITH {DAILY} SELECT station, row_number() OVER (ORDER BY station) AS id FROM (SELECT DISTINCT station FROM daily)""")
def location_index(spark, sf_dir):
    from obsledger.operators.timeline import rank_by
    return rank_by(daily(spark, sf_dir).select("station").distinct(), "station", "id", desc=False)


@query("forecast_locations", """SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)""")
def forecast_locations(spark, sf_dir):
    fc = table(spark, sf_dir, "supplier").select(F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("place"))
    return U.forecast_locations(fc, "place", table(spark, sf_dir, "nation"), "n_name").select("n_nationkey", "n_name")


@query("forecast_locations_none_found", "SELECT n_nationkey, n_name FROM nation")
def forecast_locations_none_found(spark, sf_dir):
    fc = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("place"))
    return U.forecast_locations(fc, "place", table(spark, sf_dir, "nation"), "n_name").select("n_nationkey", "n_name")


_STORED = """stored AS (SELECT o_orderstatus AS forecast_id, max(o_orderdate) OVER (PARTITION BY o_orderstatus) AS generated_at,
  o_orderpriority AS location, CAST(o_orderdate AS DATE) AS forecast_date, o_totalprice AS max_temp, o_orderkey FROM orders)"""


@query("latest_forecast_view", f"""WITH {_STORED}, l AS (SELECT forecast_id FROM stored ORDER BY generated_at DESC, forecast_id DESC LIMIT 1)
SELECT location, strftime(forecast_date, '%Y-%m-%d') AS date, CAST(round(CAST(max_temp AS DECIMAL(18, 2)), 1) AS DOUBLE) AS max_temp,
  'Unknown' AS rain_forecast FROM stored JOIN l USING (forecast_id) WHERE location = '2-HIGH'""")
def latest_forecast_view(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    newest = o.groupBy(F.col("o_orderstatus").alias("forecast_id")).agg(F.max("o_orderdate").alias("generated_at"))
    stored = o.select(F.col("o_orderstatus").alias("forecast_id"), F.col("o_orderpriority").alias("location"),
                      F.col("o_orderdate").cast("date").alias("forecast_date"), F.col("o_totalprice").alias("max_temp"),
                      F.lit(None).cast("string").alias("rain_forecast")).join(newest, "forecast_id")
    view = U.stored_view(stored, "2-HIGH", ["max_temp"])
    return unnest_forecast(view).select("location", "date", "max_temp", "rain_forecast")


def _nested(spark, sf_dir):
    three = first_n(daily(spark, sf_dir), "station", ["d"], 3)
    return nest_forecast(three.withColumn("station", F.lpad(F.col("station").cast("string"), 6, "0")), "station", "d",
                         {"min_temp": "top", "max_temp": "total"}, "rain_today")


@query("document_view", f"""WITH {DAILY}, v AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY d) AS rn FROM daily
  WHERE station = (SELECT min(station) FROM daily))
SELECT lpad(CAST(station AS VARCHAR), 6, '0') AS location, strftime(d, '%Y-%m-%d') AS date,
  CAST(round(CAST(top AS DECIMAL(18, 2)), 1) AS DOUBLE) AS min_temp, CAST(round(CAST(total AS DECIMAL(18, 2)), 1) AS DOUBLE) AS max_temp,
  rain_today AS rain_forecast FROM v WHERE rn <= 3""")
def document_view(spark, sf_dir):
    return unnest_forecast(U.document_view(_nested(spark, sf_dir)))


@query("forecast_documents", f"""WITH {DAILY}, v AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY d) AS rn FROM daily)
SELECT lpad(CAST(station AS VARCHAR), 6, '0') AS location, CAST(count(*) AS INTEGER) AS n_predictions FROM v WHERE rn <= 3 GROUP BY 1""")
def forecast_documents(spark, sf_dir):
    docs = U.forecast_document(_nested(spark, sf_dir), 3, "2024-02-01 00:00:00")
    return docs.select("location", F.get_json_object("document", "$.n_predictions").cast("int").alias("n_predictions"))


@query("forecast_records", f"""WITH {DAILY}, v AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY d) AS rn FROM daily)
SELECT 'f1_' || lpad(CAST(station AS VARCHAR), 6, '0') || '_' || strftime(d, '%Y-%m-%d') AS id, d AS forecast_date,
  CAST(round(CAST(top AS DECIMAL(18, 2)), 1) AS DOUBLE) AS min_temp, CAST(NULL AS DOUBLE) AS humidity_9am,
  'SequentialForecastSVM' AS model_name FROM v WHERE rn <= 3""")
def forecast_records(spark, sf_dir):
    return U.forecast_records(_nested(spark, sf_dir), "f1").select("id", "forecast_date", "min_temp", "humidity_9am", "model_name")


# ---- fitted forecasts and synthetic rows: checked by rows here and by properties in the tests ----

def _trained(spark, sf_dir):
    return plan.train(daily(spark, sf_dir), STATION, ["total", "top"], range_of=("total", "top"))


@query("sequence_forecast")
def sequence_forecast(spark, sf_dir):
    models, rows, _, _ = _trained(spark, sf_dir)
    return plan.forecast_entities(models, plan.latest_rows(rows, STATION), STATION, ["total", "top"], days=5)


@query("predict_wide")
def predict_wide(spark, sf_dir):
    models, rows, _, _ = _trained(spark, sf_dir)
    return H.predict_wide(rows, models, ["station", "d"])


@query("forecast_on_demand")
def forecast_on_demand(spark, sf_dir):
    models, rows, _, _ = _trained(spark, sf_dir)
    out = plan.on_demand(models, rows, STATION, ["total", "top"], {"min_temp": "top", "max_temp": "total"}, 3)
    return unnest_forecast(out)


_HISTORY = Roles(entity="station", date="d", measures=("total", "top"), categoricals=("rain_today",), label="rain_tomorrow", today="rain_today")


@query("synthetic_days")
def synthetic_days(spark, sf_dir):
    return Y.synthetic_days(daily(spark, sf_dir), STATION, 10, "2025-01-01")


@query("coherent_sequences")
def coherent_sequences(spark, sf_dir):
    rows = daily(spark, sf_dir).withColumn("rain_tomorrow", F.when(F.col("top") > 100, "Yes").otherwise("No"))
    return Y.coherent_sequences(rows, _HISTORY, ["total", "top"], start="2025-01-01", length=3)


@query("impute_random_keeps_known", """SELECT event_id, CASE WHEN value > 50 THEN event_type END AS known, event_type IS NOT NULL AS filled FROM events""")
def impute_random_keeps_known(spark, sf_dir):
    from obsledger.operators.clean import impute_random
    ev = table(spark, sf_dir, "events").select("event_id", "value", F.when(F.col("value") > 50, F.col("event_type")).alias("kind"))
    out = impute_random(ev, "kind", ["event_id"])
    return out.select("event_id", F.when(F.col("value") > 50, F.col("kind")).alias("known"), F.col("kind").isNotNull().alias("filled"))
