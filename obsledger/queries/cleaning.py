"""Projection, cleaning, imputation, calendar and outlier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import scalars as S
from obsledger.operators import clean as C
from obsledger.operators.stats import quantiles
from obsledger.queries import query
from obsledger.queries.frames import DAILY, OBS, daily, observations, rounded, table

KEY = "orderkey, linenumber, partkey, supplier, d"
_KEYS = ["orderkey", "linenumber", "partkey", "supplier", "d"]


@query("select_available", "SELECT c_name, c_acctbal, c_custkey FROM customer")
def select_available(spark, sf_dir):
    return C.select_available(table(spark, sf_dir, "customer"), ["c_name", "c_height", "c_acctbal", "c_custkey"])


@query("isin_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def isin_filter(spark, sf_dir):
    o = C.filter_in(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return o.select("o_orderkey", "o_orderpriority")


@query("equality_filter", """SELECT event_id, user_id, value FROM events
WHERE event_type = 'purchase' AND CAST(ts AS DATE) = DATE '2024-01-15'""")
def equality_filter(spark, sf_dir):
    import datetime
    ev = table(spark, sf_dir, "events").withColumn("d", F.col("ts").cast("date"))
    return C.filter_eq(ev, event_type="purchase", d=datetime.date(2024, 1, 15)).select("event_id", "user_id", "value")


@query("month_filter", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE month(o_orderdate) = 6""")
def month_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return C.filter_month(o, "d", 6)


@query("month_fallback", """WITH n AS (
  SELECT o_custkey, count(*) FILTER (month(o_orderdate) = 6) AS c FROM orders GROUP BY 1)
SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS d FROM orders o JOIN n USING (o_custkey)
WHERE n.c < 2 OR month(o.o_orderdate) = 6""")
def month_fallback(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    return C.filter_month_or_all(o, "o_custkey", "d", 6, min_rows=2).select("o_orderkey", "o_custkey", "d")


@query("dropna_subset", f"""WITH {OBS} SELECT {KEY}, quantity, flag FROM obs
WHERE quantity IS NOT NULL AND flag IS NOT NULL""")
def dropna_subset(spark, sf_dir):
    return C.drop_missing(observations(spark, sf_dir), ["quantity", "flag"]).select(*_KEYS, "quantity", "flag")


@query("training_rows", f"""WITH {OBS} SELECT {KEY}, quantity, discount, price FROM obs
WHERE price IS NOT NULL AND quantity IS NOT NULL AND discount IS NOT NULL""")
def training_rows(spark, sf_dir):
    out = C.training_rows(observations(spark, sf_dir), ["quantity", "discount"], "price")
    return out.select(*_KEYS, "quantity", "discount", "price")


@query("training_row_report", f"""WITH {OBS} SELECT count(*) FILTER (price IS NULL) AS dropped_target,
  count(*) FILTER (price IS NOT NULL AND (quantity IS NULL OR discount IS NULL)) AS dropped_features,
  count(*) FILTER (price IS NOT NULL AND quantity IS NOT NULL AND discount IS NOT NULL) AS kept FROM obs""")
def training_row_report(spark, sf_dir):
    return C.training_row_report(observations(spark, sf_dir), ["quantity", "discount"], "price")


@query("conform_schema", "SELECT c_acctbal, 0 AS c_height, c_custkey, 0 AS c_weight FROM customer")
def conform_schema(spark, sf_dir):
    return C.conform(table(spark, sf_dir, "customer"), ["c_acctbal", "c_height", "c_custkey", "c_weight"])


@query("yesno_encode", f"WITH {DAILY} SELECT station, d, CASE rain_today WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS rain FROM daily")
def yesno_encode(spark, sf_dir):
    return daily(spark, sf_dir).select("station", "d", S.yesno_to_int("rain_today").alias("rain"))


@query("yesno_decode", "SELECT doc_id, CASE WHEN quality = 1 THEN 'Yes' ELSE 'No' END AS good FROM labels")
def yesno_decode(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", S.int_to_yesno("quality").alias("good"))


@query("lenient_number", r"""WITH t AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN ' ' || CAST(value AS VARCHAR) || ' ' WHEN 'view' THEN 'NaN'
    WHEN 'error' THEN 'n/a' WHEN 'purchase' THEN regexp_extract(props, '([0-9]+)', 1) ELSE ' null ' END AS raw
  FROM events)
SELECT event_id, CASE WHEN lower(trim(raw)) IN ('', 'nan', 'null', 'none') THEN -1.0
  ELSE coalesce(TRY_CAST(trim(raw) AS DOUBLE), -1.0) END AS number FROM t""")
def lenient_number(spark, sf_dir):
    kind = F.col("event_type")
    raw = (F.when(kind == "click", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
            .when(kind == "view", "NaN").when(kind == "error", "n/a")
            .when(kind == "purchase", F.regexp_extract("props", "([0-9]+)", 1)).otherwise(" null "))
    return table(spark, sf_dir, "events").select("event_id", S.lenient_double(raw, -1.0).alias("number"))


@query("truthy_text", f"""WITH {DAILY}, t AS (
  SELECT station, d, CASE WHEN n_events > 4 THEN upper(rain_today) WHEN n_events > 2 THEN CAST(n_events - 2 AS INTEGER)::VARCHAR
    ELSE rain_today END AS raw FROM daily)
SELECT station, d, coalesce(lower(raw) IN ('yes', '1', 'true'), FALSE) AS is_rain FROM t""")
def truthy_text(spark, sf_dir):
    raw = (F.when(F.col("n_events") > 4, F.upper("rain_today"))
            .when(F.col("n_events") > 2, (F.col("n_events") - 2).cast("int").cast("string"))
            .otherwise(F.col("rain_today")))
    return daily(spark, sf_dir).select("station", "d", S.truthy(raw).alias("is_rain"))


@query("range_feature", f"WITH {DAILY} SELECT station, d, round(total - top, 4) AS spread FROM daily")
def range_feature(spark, sf_dir):
    return rounded(daily(spark, sf_dir).select("station", "d", S.value_range("total", "top").alias("spread")), "spread")


@query("code_lookup", """SELECT c.c_custkey, coalesce(n.n_regionkey, 0) AS region_code
FROM customer c LEFT JOIN nation n ON n.n_name = 'NATION_' || c.c_nationkey::VARCHAR AND n.n_nationkey < 20""")
def code_lookup(spark, sf_dir):
    dim = (table(spark, sf_dir, "nation").where("n_nationkey < 20")
           .select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("code")))
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("nation"))
    return C.encode_code(c, "nation", dim, "region_code").select("c_custkey", "region_code")


_HOT = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS \"o_orderpriority_{v}\"" for v in _HOT) + " FROM orders")
def one_hot(spark, sf_dir):
    return C.one_hot(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query("one_hot_drop_first", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderstatus = '{v}' THEN 1 ELSE 0 END AS \"o_orderstatus_{v}\"" for v in "OP") + " FROM orders")
def one_hot_drop_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return C.one_hot(o, "o_orderstatus", drop_first=True)


@query("round_publish", f"""WITH {OBS} SELECT {KEY},
  CAST(round(CAST(coalesce(price, 0) AS DECIMAL(18, 2)), 1) AS DOUBLE) AS price FROM obs""")
def round_publish(spark, sf_dir):
    return observations(spark, sf_dir).select(*_KEYS, S.publish_round("price").alias("price"))


# ---- imputation ----------------------------------------------------------------

@query("impute_median", f"""WITH {OBS}, m AS (SELECT median(quantity) AS q, median(price) AS p FROM obs)
SELECT {KEY}, round(coalesce(quantity, q), 4) AS quantity, round(coalesce(price, p), 4) AS price FROM obs, m""")
def impute_median(spark, sf_dir):
    out = C.impute(observations(spark, sf_dir), ["quantity", "price"], "median")
    return rounded(out.select(*_KEYS, "quantity", "price"), "quantity", "price")


@query("impute_median_narrowed", f"""WITH {OBS}, m AS (SELECT median(price) AS p FROM obs)
SELECT {KEY}, round(coalesce(price, p), 4) AS price FROM obs, m""")
def impute_median_narrowed(spark, sf_dir):
    obs = observations(spark, sf_dir)
    fill = quantiles(obs, ["price"], [0.5], max_rows=10).select(F.col("price")[0].alias("price"))
    return rounded(C.apply_imputer(obs, fill).select(*_KEYS, "price"), "price")


@query("impute_median_cols", f"""WITH {OBS}, m AS (SELECT median(quantity) AS q FROM obs)
SELECT {KEY}, round(coalesce(quantity, q), 4) AS quantity, price FROM obs, m""")
def impute_median_cols(spark, sf_dir):
    out = C.impute(observations(spark, sf_dir), ["quantity"], "median")
    return rounded(out.select(*_KEYS, "quantity", "price"), "quantity")


@query("impute_mode", f"""WITH {OBS},
f AS (SELECT flag FROM obs WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1),
s AS (SELECT status FROM obs WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)
SELECT {KEY}, coalesce(flag, (SELECT flag FROM f)) AS flag, coalesce(status, (SELECT status FROM s)) AS status FROM obs""")
def impute_mode(spark, sf_dir):
    return C.impute(observations(spark, sf_dir), ["flag", "status"], "mode").select(*_KEYS, "flag", "status")


@query("impute_mean", f"""WITH {OBS}, m AS (SELECT avg(quantity) AS q, avg(price) AS p FROM obs)
SELECT {KEY}, round(coalesce(quantity, q), 4) AS quantity, round(coalesce(price, p), 4) AS price FROM obs, m""")
def impute_mean(spark, sf_dir):
    out = C.impute(observations(spark, sf_dir), ["quantity", "price"], "mean")
    return rounded(out.select(*_KEYS, "quantity", "price"), "quantity", "price")


@query("impute_coerced_mean", r"""WITH t AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
    CAST(CASE WHEN event_type = 'view' THEN NULL ELSE regexp_extract(props, '([0-9]+)', 1) END AS DOUBLE) AS k FROM events),
m AS (SELECT avg(value) AS mv, avg(k) AS mk FROM t)
SELECT event_id, round(coalesce(value, mv), 4) AS value, round(coalesce(k, mk), 4) AS k FROM t, m""")
def impute_coerced_mean(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "view", "none").otherwise(F.regexp_extract("props", "([0-9]+)", 1)).alias("k"),
        F.col("event_type").alias("wordy"))
    return rounded(C.impute_coerced_mean(ev, ["value", "k", "wordy"]), "value", "k")


@query("impute_mode_unknown", f"""WITH {OBS}, e AS (SELECT {KEY}, flag, CAST(NULL AS VARCHAR) AS blank FROM obs),
f AS (SELECT flag FROM e WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
SELECT {KEY}, coalesce(flag, (SELECT flag FROM f), 'Unknown') AS flag, coalesce(blank, 'Unknown') AS blank FROM e""")
def impute_mode_unknown(spark, sf_dir):
    e = observations(spark, sf_dir).select(*_KEYS, "flag", F.lit(None).cast("string").alias("blank"))
    return C.impute(e, ["flag", "blank"], "mode", fallback="Unknown")


@query("fill_zero", f"WITH {OBS} SELECT {KEY}, coalesce(quantity, 0) AS quantity, coalesce(price, 0) AS price FROM obs")
def fill_zero(spark, sf_dir):
    return C.impute(observations(spark, sf_dir), ["quantity", "price"], "zero").select(*_KEYS, "quantity", "price")


# ---- dates, text, scalars ------------------------------------------------------

@query("parse_date_strict", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders""")
def parse_date_strict(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("text", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", S.parse_date("text").alias("d"))


@query("parse_date_lenient", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d
FROM orders""")
def parse_date_lenient(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "'day' dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.parse_date(text, lenient=True).alias("d"))


@query("calendar_parts", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month",
  CAST(day(o_orderdate) AS INTEGER) AS "Day", CAST(isodow(o_orderdate) - 1 AS INTEGER) AS "DayOfWeek" FROM orders""")
def calendar_parts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return C.add_calendar(o, "d", ("Year", "Month", "Day", "DayOfWeek"), None).drop("d")


@query("quarter_doy", """SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS "Quarter",
  CAST(dayofyear(o_orderdate) AS INTEGER) AS "DayOfYear" FROM orders""")
def quarter_doy(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return C.add_calendar(o, "d", ("Quarter", "DayOfYear"), None).drop("d")


_DATE_OR_NONE = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END"


@query("season_en", f"""SELECT o_orderkey, CASE WHEN month({_DATE_OR_NONE}) IN (3, 4, 5) THEN 'Autumn'
  WHEN month({_DATE_OR_NONE}) IN (6, 7, 8) THEN 'Winter' WHEN month({_DATE_OR_NONE}) IN (9, 10, 11) THEN 'Spring'
  WHEN month({_DATE_OR_NONE}) IN (12, 1, 2) THEN 'Summer' ELSE 'Unknown' END AS season FROM orders""")
def season_en(spark, sf_dir):
    d = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.season(F.month(d), "en").alias("season"))


@query("season_es", f"""SELECT o_orderkey, CASE WHEN month({_DATE_OR_NONE}) IN (12, 1, 2) THEN 'Verano'
  WHEN month({_DATE_OR_NONE}) IN (3, 4, 5) THEN 'Otoño' WHEN month({_DATE_OR_NONE}) IN (6, 7, 8) THEN 'Invierno'
  ELSE 'Primavera' END AS season FROM orders""")
def season_es(spark, sf_dir):
    d = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.season(F.month(d), "es").alias("season"))


@query("default_calendar", """SELECT c_custkey, 6 AS "Month", 150 AS "DayOfYear" FROM customer""")
def default_calendar(spark, sf_dir):
    return C.default_calendar(table(spark, sf_dir, "customer").select("c_custkey"))


@query("next_day_text", """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS next_date FROM orders""")
def next_day_text(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", S.date_text("o_orderdate", 1).alias("next_date"))


@query("entity_date_key", f"WITH {DAILY} SELECT station || '_' || strftime(d, '%Y-%m-%d') AS \"key\", total FROM daily")
def entity_date_key(spark, sf_dir):
    return daily(spark, sf_dir).select(S.entity_date_key("station", "d").alias("key"), "total")


@query("strip_prefix", "SELECT c_custkey, regexp_replace(c_name, '^Customer#', '') AS code FROM customer")
def strip_prefix(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.strip_prefix("c_name", "Customer#").alias("code"))


@query("text_match", "SELECT n_nationkey, n_name FROM nation WHERE lower(n_name) = lower('Nation_7')")
def text_match(spark, sf_dir):
    return table(spark, sf_dir, "nation").where(S.same_text("n_name", F.lit("Nation_7"))).select("n_nationkey", "n_name")


@query("deviation_pct", f"""WITH {DAILY} SELECT station, d,
  round(abs(total - top) / nullif(top, 0) * 100, 4) AS deviation FROM daily""")
def deviation_pct(spark, sf_dir):
    return rounded(daily(spark, sf_dir).select("station", "d", S.deviation_pct("total", "top").alias("deviation")), "deviation")


@query("rain_label", """SELECT orderkey, n, CASE WHEN p > 0.5 THEN 'Yes' ELSE 'No' END AS rain FROM (
  SELECT l_orderkey AS orderkey, count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS p
  FROM lineitem GROUP BY l_orderkey)""")
def rain_label(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("l_returnflag") == "R").cast("double")).alias("p"))
    return p.select("orderkey", "n", S.rain_label("p").alias("rain"))


@query("weather_condition", f"""WITH {OBS} SELECT {KEY}, CASE WHEN lower(flag) = 'r' THEN 'Rainy'
  WHEN coalesce(quantity / 5, 8) > 7 THEN 'Sunny' ELSE 'Partly Cloudy' END AS condition FROM obs""")
def weather_condition(spark, sf_dir):
    rain = F.when(F.lower("flag") == "r", "Yes").otherwise("No")
    return observations(spark, sf_dir).select(*_KEYS, S.weather_condition(rain, F.col("quantity") / 5).alias("condition"))


@query("precipitation_score", f"""WITH {OBS} SELECT {KEY}, round(coalesce(quantity, 30) * 3, 4) AS score,
  round(least(coalesce(quantity, 30) * 3, 100), 4) AS capped FROM obs""")
def precipitation_score(spark, sf_dir):
    out = observations(spark, sf_dir).select(
        *_KEYS, S.precipitation_score("quantity").alias("score"),
        S.precipitation_score("quantity", cap=100).alias("capped"))
    return rounded(out, "score", "capped")


# ---- outliers --------------------------------------------------------------------

_Q = """q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
f AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)"""


@query("iqr_bounds", f"""WITH {_Q} SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(lower, 4) AS lower,
  round(upper, 4) AS upper FROM f""")
def iqr_bounds(spark, sf_dir):
    return rounded(C.iqr_bounds(table(spark, sf_dir, "events"), ["value"]).select("value.*"), "q1", "q3", "lower", "upper")


@query("outlier_flag", f"""WITH {_Q}, e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events),
q2 AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM e)
SELECT event_id, coalesce(CAST(value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS INTEGER), 0) AS "value_Outlier"
FROM e, q2""")
def outlier_flag(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return C.flag_outliers(ev, ["value"]).select("event_id", "value_Outlier")


@query("clip_upper", f"WITH {_Q} SELECT event_id, round(CASE WHEN value > upper THEN upper ELSE value END, 4) AS value FROM events, f")
def clip_upper(spark, sf_dir):
    return rounded(C.clip_upper(table(spark, sf_dir, "events").select("event_id", "value"), ["value"]), "value")


@query("outlier_count", f"""WITH {_Q} SELECT 'value' AS "column", count(*) FILTER (value < lower OR value > upper) AS n_outliers
FROM events, f""")
def outlier_count(spark, sf_dir):
    return C.outlier_counts(table(spark, sf_dir, "events"), ["value"])


@query("extreme_rate", f"""WITH {_Q} SELECT user_id, count(*) AS n, count(*) FILTER (value < lower OR value > upper) AS n_extreme,
  round(avg(CASE WHEN value < lower OR value > upper THEN 1.0 ELSE 0.0 END), 6) AS extreme_rate FROM events, f GROUP BY user_id""")
def extreme_rate(spark, sf_dir):
    return rounded(C.extreme_rate(table(spark, sf_dir, "events"), "user_id", "value"), "extreme_rate", digits=6)
