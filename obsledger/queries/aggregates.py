"""Grouped means, risk scores, contrasts and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.operators import aggregate as A
from obsledger.operators import evaluate as E
from obsledger.operators import insight as I
from obsledger.queries import query
from obsledger.queries.frames import DAILY, OBS, daily, observations, rounded, table


@query("mean_by_entity", f"""WITH {OBS} SELECT supplier, round(avg(quantity), 4) AS mean_quantity,
  round(avg(price), 4) AS mean_price FROM obs GROUP BY 1""")
def mean_by_entity(spark, sf_dir):
    out = A.mean_by(observations(spark, sf_dir), "supplier", ["quantity", "price"])
    return rounded(out, "mean_quantity", "mean_price").orderBy(F.desc("mean_quantity"), "supplier")


@query("mean_by_entity_season", f"""WITH {OBS} SELECT supplier, round(avg(price), 4) AS mean_price FROM obs
WHERE month(d) IN (12, 1, 2) GROUP BY 1""")
def mean_by_entity_season(spark, sf_dir):
    return rounded(A.mean_by(observations(spark, sf_dir), "supplier", ["price"], F.month("d").isin(12, 1, 2)), "mean_price")


@query("risk_index", """SELECT 'run_001' AS run_id, l_suppkey AS city,
  round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS climate_risk_index FROM lineitem GROUP BY 2""")
def risk_index(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_returnflag") == "R").cast("int").alias("p"))
    return rounded(A.risk_index(li, "l_suppkey", "p", "run_001"), "climate_risk_index", digits=6)


@query("cluster_profile", """SELECT label, round(avg(e1), 6) AS e1, round(avg(e2), 6) AS e2, round(avg(e3), 6) AS e3 FROM (
  SELECT label, CAST(embedding[1] AS DOUBLE) AS e1, CAST(embedding[2] AS DOUBLE) AS e2, CAST(embedding[3] AS DOUBLE) AS e3 FROM embeddings)
GROUP BY 1""")
def cluster_profile(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", *[F.col("embedding")[i].cast("double").alias(f"e{i + 1}") for i in range(3)])
    return rounded(A.cluster_profile(e, "label", ["e1", "e2", "e3"]), "e1", "e2", "e3", digits=6)


@query("global_stats", f"""WITH {OBS} SELECT round(avg(quantity), 4) AS mean_quantity, round(stddev_samp(quantity), 4) AS std_quantity,
  max(d) AS max_date, round(median(quantity), 4) AS median_quantity, round(quantile_cont(quantity, 0.25), 4) AS q25_quantity,
  round(quantile_cont(quantity, 0.75), 4) AS q75_quantity FROM obs""")
def global_stats(spark, sf_dir):
    out = A.global_stats(observations(spark, sf_dir), ["quantity"], "d")
    return rounded(out, "mean_quantity", "std_quantity", "median_quantity", "q25_quantity", "q75_quantity")


_FLAGGED = """e AS (SELECT l_linenumber AS cluster, CASE WHEN l_extendedprice > 90000 THEN 1 ELSE 0 END AS is_anomaly,
  l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem)"""


def _flagged(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("cluster"), (F.col("l_extendedprice") > 90000).cast("int").alias("is_anomaly"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


@query("cluster_anomaly_rate", f"""WITH {_FLAGGED}, r AS (SELECT cluster, avg(is_anomaly) * 100 AS rate_pct FROM e GROUP BY 1),
m AS (SELECT avg(rate_pct) AS m FROM r)
SELECT cluster, round(rate_pct, 4) AS rate_pct, round(m, 4) AS mean_rate_pct, CAST(rate_pct > m AS INTEGER) AS is_high FROM r, m""")
def cluster_anomaly_rate(spark, sf_dir):
    return rounded(A.rate_by_cluster(_flagged(spark, sf_dir), "cluster", "is_anomaly"), "rate_pct", "mean_rate_pct")


_CONTRAST = f"""{_FLAGGED}, u AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) FILTER (is_anomaly = 1) AS flagged_mean, avg({c}) FILTER (is_anomaly = 0) AS normal_mean FROM e" for c in ("quantity", "price", "discount", "tax"))}),
c AS (SELECT *, flagged_mean - normal_mean AS difference, abs(flagged_mean - normal_mean) / nullif(normal_mean, 0) * 100 AS pct,
  CASE WHEN flagged_mean > normal_mean THEN 'mayor' ELSE 'menor' END AS direction FROM u)"""


@query("group_contrast", f"""WITH {_CONTRAST} SELECT feature, round(flagged_mean, 4) AS flagged_mean, round(normal_mean, 4) AS normal_mean,
  round(difference, 4) AS difference, round(pct, 4) AS pct, direction FROM c""")
def group_contrast(spark, sf_dir):
    out = A.contrast(_flagged(spark, sf_dir), "is_anomaly", ["quantity", "price", "discount", "tax"])
    return rounded(out, "flagged_mean", "normal_mean", "difference", "pct")


@query("contrast_insight", f"""WITH {_CONTRAST}, r AS (
  SELECT *, CAST(row_number() OVER (ORDER BY abs(difference) DESC, feature) AS INTEGER) AS "rank" FROM c)
SELECT feature, direction, "rank", round(difference, 4) AS difference, round(pct, 4) AS pct,
  (SELECT count(*) FILTER (is_anomaly = 1) FROM e) AS n_flagged,
  round((SELECT count(*) FILTER (is_anomaly = 1) * 100.0 / count(*) FROM e), 4) AS flagged_pct
FROM r WHERE "rank" <= 3""")
def contrast_insight(spark, sf_dir):
    out = I.contrast_insights(_flagged(spark, sf_dir), "is_anomaly", ["quantity", "price", "discount", "tax"])
    return rounded(out, "difference", "pct", "flagged_pct").drop("flagged_mean", "normal_mean")


@query("density_insight", f"""WITH {_FLAGGED}, k AS (SELECT CASE WHEN is_anomaly = 1 THEN -1 ELSE cluster END AS c FROM e)
SELECT c AS dbscan_cluster, count(*) AS size, round(count(*) * 100.0 / (SELECT count(*) FROM e), 4) AS percentage
FROM k WHERE c <> -1 GROUP BY 1""")
def density_insight(spark, sf_dir):
    k = _flagged(spark, sf_dir).withColumn("dbscan_cluster", F.when(F.col("is_anomaly") == 1, -1).otherwise(F.col("cluster")))
    return rounded(I.density_insights(k, "dbscan_cluster", ["price", "tax"])[1], "percentage")


@query("cluster_insight", f"""WITH {_FLAGGED}, g AS (SELECT count(*) AS n, {", ".join(f"avg({c}) AS {c}" for c in ("quantity", "price", "discount", "tax"))} FROM e),
m AS (SELECT cluster, count(*) AS size, {", ".join(f"avg({c}) AS {c}" for c in ("quantity", "price", "discount", "tax"))} FROM e GROUP BY 1),
u AS ({" UNION ALL ".join(f"SELECT m.cluster, m.size, m.size * 100.0 / g.n AS percentage, '{c}' AS feature, m.{c} AS cluster_mean, g.{c} AS global_mean FROM m, g" for c in ("quantity", "price", "discount", "tax"))}),
r AS (SELECT *, cluster_mean - global_mean AS difference,
  CAST(row_number() OVER (PARTITION BY cluster ORDER BY abs(cluster_mean - global_mean) DESC, feature) AS INTEGER) AS "rank" FROM u)
SELECT cluster, size, round(percentage, 4) AS percentage, feature, round(cluster_mean, 4) AS cluster_mean, "rank",
  CASE WHEN difference > 0 THEN 'alto' ELSE 'bajo' END AS direction,
  round(abs(difference) / nullif(abs(global_mean), 0) * 100, 4) AS deviation_pct FROM r WHERE "rank" <= 3""")
def cluster_insight(spark, sf_dir):
    out = I.cluster_insights(_flagged(spark, sf_dir), "cluster", ["quantity", "price", "discount", "tax"])
    return rounded(out, "percentage", "cluster_mean", "deviation_pct").drop("global_mean", "difference")


@query("cross_insight", """WITH c AS (SELECT o_orderkey, o_orderpriority AS cluster FROM orders),
f AS (SELECT l_orderkey AS o_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS flag FROM lineitem GROUP BY 1),
r AS (SELECT cluster, avg(flag) * 100 AS rate_pct FROM c JOIN f USING (o_orderkey) GROUP BY 1), m AS (SELECT avg(rate_pct) AS m FROM r)
SELECT cluster, round(rate_pct, 4) AS rate_pct, round(m, 4) AS mean_rate_pct, CAST(rate_pct > m AS INTEGER) AS is_high FROM r, m""")
def cross_insight(spark, sf_dir):
    c = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("cluster"))
    f = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("flag"))
    return rounded(I.cross_insights(c, f, ["o_orderkey"], "cluster", "flag"), "rate_pct", "mean_rate_pct")


@query("group_share", """SELECT c_mktsegment, count(*) AS size,
  round(count(*) * 100.0 / (SELECT count(*) FROM customer), 4) AS percentage FROM customer GROUP BY 1""")
def group_share(spark, sf_dir):
    return rounded(A.group_share(table(spark, sf_dir, "customer"), "c_mktsegment"), "percentage")


@query("distinct_dates", "SELECT count(DISTINCT CAST(ts AS DATE)) AS n_days FROM events")
def distinct_dates(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d"))
    return A.distinct_count(ev, "d", "n_days")


@query("kpi_days", f"""WITH {DAILY} SELECT station, count(*) FILTER (total > 100) AS heavy_days, count(*) FILTER (rain_today = 'Yes') AS rain_days,
  round(avg(top), 8) AS mean_top, round(stddev_samp(top), 8) AS std_top FROM daily GROUP BY 1""")
def kpi_days(spark, sf_dir):
    rules = {"heavy_days": F.col("total") > 100, "rain_days": F.col("rain_today") == "Yes"}
    return rounded(A.threshold_days(daily(spark, sf_dir), "station", rules, ["top"]), "mean_top", "std_top", digits=8)


_PARTS = ("quantity", "price", "discount", "tax")


def _risk_sql(extra: str) -> str:
    by = f", {extra}" if extra else ""
    over = f"(PARTITION BY {extra})" if extra else "()"
    season = ", CASE WHEN month(d) <= 6 THEN 'first' ELSE 'second' END AS half" if extra else ""
    scale = ", ".join(
        f"(({'1 - ' if c == 'discount' else ''}({c} - min({c}) OVER {over}) / nullif(max({c}) OVER {over} - min({c}) OVER {over}, 0))) * 0.25 AS {c}"
        for c in _PARTS)
    return f"""WITH {OBS}, o2 AS (SELECT * {season} FROM obs),
m AS (SELECT supplier{by}, {", ".join(f"avg({c}) AS {c}" for c in _PARTS)} FROM o2 GROUP BY ALL),
s AS (SELECT supplier{by}, {scale} FROM m),
t AS (SELECT *, quantity + price + discount + tax AS score FROM s)
SELECT supplier{by}, round(score, 6) AS score, CASE greatest(quantity, price, discount, tax) WHEN quantity THEN 'quantity'
  WHEN price THEN 'price' WHEN discount THEN 'discount' ELSE 'tax' END AS top_factor,
  rank() OVER (PARTITION BY {extra or 1} ORDER BY score DESC) AS "rank" FROM t"""


@query("composite_risk", _risk_sql(""))
def composite_risk(spark, sf_dir):
    out = A.composite_risk(observations(spark, sf_dir), "supplier", dict.fromkeys(_PARTS, 0.25), invert=("discount",))
    return rounded(out, "score", digits=6)


@query("composite_risk_by_season", _risk_sql("half"))
def composite_risk_by_season(spark, sf_dir):
    obs = observations(spark, sf_dir).withColumn("half", F.when(F.month("d") <= 6, "first").otherwise("second"))
    out = A.composite_risk(obs, "supplier", dict.fromkeys(_PARTS, 0.25), invert=("discount",), by="half")
    return rounded(out, "score", digits=6)


# ---- evaluation ------------------------------------------------------------------

@query("regression_metrics", """WITH p AS (SELECT l_returnflag AS g, l_extendedprice AS y, l_quantity * 1000 + l_tax * 100 AS p FROM lineitem)
SELECT g, count(*) AS n, round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(avg(abs(y - p)), 4) AS mae, round(1 - avg((y - p) * (y - p)) / nullif(var_pop(y), 0), 6) AS r2 FROM p GROUP BY 1""")
def regression_metrics(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("g"), F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 1000 + F.col("l_tax") * 100).alias("p"))
    out = E.regression_metrics(p, "y", "p", ["g"])
    return rounded(rounded(rounded(out, "mse", digits=2), "rmse", "mae"), "r2", digits=6)


_PAIR = "p AS (SELECT quality AS y, 1 - toxic AS p FROM labels)"
_COUNTS = f"""{_PAIR}, c AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (y = p) AS DOUBLE) AS hit,
  CAST(count(*) FILTER (y = 1 AND p = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (y = 0 AND p = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (y = 1 AND p = 0) AS DOUBLE) AS fn FROM p)"""


def _pair(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("quality").alias("y"), (1 - F.col("toxic")).alias("p"))


@query("classification_metrics", f"""WITH {_COUNTS} SELECT CAST(n AS BIGINT) AS n, round(hit / n, 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def classification_metrics(spark, sf_dir):
    return rounded(E.classification_metrics(_pair(spark, sf_dir), "y", "p"), "accuracy", "precision", "recall", "f1", digits=6)


@query("class_report", f"""WITH {_PAIR}, k AS (SELECT DISTINCT y AS class FROM p UNION SELECT DISTINCT p FROM p),
c AS (SELECT class, CAST(count(*) FILTER (y = class AND p = class) AS DOUBLE) AS tp, CAST(count(*) FILTER (p = class) AS DOUBLE) AS said,
  count(*) FILTER (y = class) AS support FROM k, p GROUP BY 1)
SELECT class, round(coalesce(tp / nullif(said, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(support, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(said + support, 0), 0), 6) AS f1, support FROM c""")
def class_report(spark, sf_dir):
    return rounded(E.class_report(_pair(spark, sf_dir), "y", "p"), "precision", "recall", "f1", digits=6)


@query("confusion_matrix", f"WITH {_PAIR} SELECT y AS actual, p AS predicted, count(*) AS n FROM p GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return E.confusion(_pair(spark, sf_dir), "y", "p")


@query("forecast_error", f"""WITH {DAILY}, f AS (SELECT station, d + h AS d, h AS horizon, total, top, n_events FROM daily, (VALUES (1), (2), (3)) v(h)),
j AS (SELECT f.horizon, f.total - a.total AS total, f.top - a.top AS top, f.n_events - a.n_events AS n_events
  FROM f JOIN daily a ON a.station = f.station AND a.d = f.d),
u AS (SELECT horizon, 'total' AS variable, total AS err FROM j UNION ALL SELECT horizon, 'top', top FROM j
  UNION ALL SELECT horizon, 'n_events', n_events FROM j)
SELECT horizon, variable, count(*) AS n, round(avg(abs(err)), 4) AS mae, round(sqrt(avg(err * err)), 4) AS rmse FROM u GROUP BY 1, 2""")
def forecast_error(spark, sf_dir):
    actual = daily(spark, sf_dir)
    carried = actual.select("station", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("horizon"), "d", "total", "top", "n_events")
    carried = carried.withColumn("d", F.date_add("d", F.col("horizon")))
    out = E.forecast_error(carried, actual, ["station", "d"], ["total", "top", "n_events"], "horizon")
    return rounded(out, "mae", "rmse")


@query("forecast_status", f"""WITH {DAILY} SELECT count(DISTINCT d) FILTER (rain_today = 'Yes') AS forecast_days,
  count(DISTINCT d) AS actual_days, 'evaluated' AS status FROM daily""")
def forecast_status(spark, sf_dir):
    actual = daily(spark, sf_dir)
    return E.forecast_status(actual.where("rain_today = 'Yes'"), actual, "d")
