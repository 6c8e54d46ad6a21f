"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.operators import profile as P
from obsledger.queries import query
from obsledger.queries.frames import MEASURES, OBS, observations, rounded, table

_OBS_COLS = ["quantity", "price", "discount", "tax", "flag", "status"]


@query("null_profile", f"""WITH {OBS}, n AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null FROM obs" for c in _OBS_COLS)})
SELECT "column", n_null FROM n WHERE n_null > 0""")
def null_profile(spark, sf_dir):
    return P.null_profile(observations(spark, sf_dir), _OBS_COLS)


@query("dup_rows", """WITH g AS (
  SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_dup FROM g""")
def dup_rows(spark, sf_dir):
    return P.duplicate_count(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@query("dup_rows_full", """SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_dup FROM (
  SELECT count(*) AS c FROM events GROUP BY event_id, ts, user_id, event_type, value, props)""")
def dup_rows_full(spark, sf_dir):
    return P.duplicate_count(table(spark, sf_dir, "events"))


def _describe_sql(cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, min({c}) AS "min", round(quantile_cont({c}, 0.25), 4) AS p25,
  round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, max({c}) AS "max" FROM obs"""
        for c in cols)


@query("describe_num", f"WITH {OBS} {_describe_sql(MEASURES)}")
def describe_num(spark, sf_dir):
    return rounded(P.describe(observations(spark, sf_dir), MEASURES), "mean", "std", "p25", "p50", "p75")


@query("iqr_profile", f"WITH {OBS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
  round(quantile_cont({c}, 0.75), 4) AS q3,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr FROM obs""" for c in MEASURES))
def iqr_profile(spark, sf_dir):
    return rounded(P.iqr_profile(observations(spark, sf_dir), MEASURES), "q1", "median", "q3", "iqr")


@query("histogram", """WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(CAST(floor((value - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin FROM events, s)
SELECT bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 30, 4) AS lo,
       round(any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 30, 4) AS hi, count(*) AS n
FROM b, s GROUP BY bin""")
def histogram(spark, sf_dir):
    return rounded(P.histogram(table(spark, sf_dir, "events"), "value", 30), "lo", "hi")


_SPANS = " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS v, min({c}) OVER () AS lo, max({c}) OVER () AS hi FROM obs" for c in MEASURES)


@query("histogram_all", f"""WITH {OBS}, s AS ({_SPANS}), b AS (SELECT *, least(CAST(floor((v - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin FROM s WHERE v IS NOT NULL)
SELECT c AS "column", bin, round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 30), 4) AS lo,
  round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 30), 4) AS hi, count(*) AS n FROM b GROUP BY c, bin""")
def histogram_all(spark, sf_dir):
    """All measures at once, in two scans."""
    return rounded(P.histograms(observations(spark, sf_dir), MEASURES), "lo", "hi")


@query("corr_matrix", f"WITH {OBS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM obs" for a in MEASURES for b in MEASURES))
def corr_matrix(spark, sf_dir):
    return rounded(P.correlations(observations(spark, sf_dir), MEASURES), "r", digits=6)


@query("grouped_quantiles", """SELECT event_type, count(value) AS n, round(quantile_cont(value, 0.25), 4) AS p25,
  round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75
FROM events GROUP BY event_type""")
def grouped_quantiles(spark, sf_dir):
    out = P.quantiles_by(table(spark, sf_dir, "events"), ["event_type"], "value", [0.25, 0.5, 0.75])
    return rounded(out, "p25", "p50", "p75")


@query("season_quantiles", """WITH o AS (
  SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Verano' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Otoño'
    WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Invierno' ELSE 'Primavera' END AS "Season", o_totalprice FROM orders)
SELECT "Season", count(*) AS n, round(quantile_cont(o_totalprice, 0.25), 4) AS p25,
  round(quantile_cont(o_totalprice, 0.5), 4) AS p50, round(quantile_cont(o_totalprice, 0.75), 4) AS p75
FROM o GROUP BY 1""")
def season_quantiles(spark, sf_dir):
    from obsledger.functions.scalars import season
    o = table(spark, sf_dir, "orders").select(season(F.month("o_orderdate"), "es").alias("Season"), "o_totalprice")
    return rounded(P.quantiles_by(o, ["Season"], "o_totalprice", [0.25, 0.5, 0.75]), "p25", "p50", "p75")


@query("distinct_sorted", "SELECT DISTINCT event_type FROM events ORDER BY event_type")
def distinct_sorted(spark, sf_dir):
    return P.distinct_values(table(spark, sf_dir, "events"), "event_type")


@query("value_counts", f"""WITH {OBS} SELECT flag AS value, count(*) AS n,
  round(count(*) * 100.0 / (SELECT count(*) FROM obs), 4) AS pct FROM obs GROUP BY flag""")
def value_counts(spark, sf_dir):
    return rounded(P.value_counts(observations(spark, sf_dir), "flag"), "pct")


@query("class_balance", """SELECT count(*) FILTER (y = 0) AS n_neg, count(*) FILTER (y = 1) AS n_pos,
  round(count(*) FILTER (y = 0) / CAST(count(*) AS DOUBLE), 6) AS share_neg,
  round(count(*) FILTER (y = 1) / CAST(count(*) AS DOUBLE), 6) AS share_pos
FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders)""")
def class_balance(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return rounded(P.class_balance(o, "y"), "share_neg", "share_pos", digits=6)


@query("coverage", f"WITH {OBS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n_valid, count(*) AS n_total,
  round(count({c}) * 100.0 / count(*), 4) AS pct FROM obs""" for c in _OBS_COLS))
def coverage(spark, sf_dir):
    return rounded(P.coverage(observations(spark, sf_dir), _OBS_COLS), "pct")


@query("shape", "SELECT count(*) AS n_rows, 6 AS n_cols FROM orders")
def shape(spark, sf_dir):
    return P.shape(table(spark, sf_dir, "orders"))


@query("numeric_columns_profile", """SELECT 'l_discount' AS "column", min(l_discount) AS lo, max(l_discount) AS hi FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice) FROM lineitem
UNION ALL SELECT 'l_quantity', min(l_quantity), max(l_quantity) FROM lineitem
UNION ALL SELECT 'l_tax', min(l_tax), max(l_tax) FROM lineitem""")
def numeric_columns_profile(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return P.describe(li, P.columns_of(li, "numeric")).select("column", F.col("min").alias("lo"), F.col("max").alias("hi"))
