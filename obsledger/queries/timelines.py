"""Joins on dates and keys, row shifts, splits, ranks and reshapes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from obsledger.functions import scalars as S
from obsledger.operators import reshape as R
from obsledger.operators import timeline as L
from obsledger.queries import query
from obsledger.queries.frames import DAILY, DAY_MEASURES, daily, rounded, table


@query("next_day_label", f"""WITH {DAILY} SELECT t.station, t.d, t.total, n.rain_today AS rain_tomorrow
FROM daily t LEFT JOIN daily n ON n.station = t.station AND n.d = t.d + 1""")
def next_day_label(spark, sf_dir):
    out = L.next_day_label(daily(spark, sf_dir), "station", "d", "rain_today", "rain_tomorrow")
    return out.select("station", "d", "total", "rain_tomorrow")


@query("next_day_label_repeats", """WITH e AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS d, CASE WHEN event_type = 'purchase' THEN 'Yes' ELSE 'No' END AS bought FROM events),
n AS (SELECT user_id, d, bought, count(*) AS c FROM e GROUP BY ALL)
SELECT e.event_id, e.user_id, e.d, n.bought AS bought_next, n.c AS bought_next_copies
FROM e LEFT JOIN n ON n.user_id = e.user_id AND n.d = e.d + 1""")
def next_day_label_repeats(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("d"),
        F.when(F.col("event_type") == "purchase", "Yes").otherwise("No").alias("bought"))
    out = L.next_day_label(ev, "user_id", "d", "bought", "bought_next", repeats="each")
    return out.select("event_id", "user_id", "d", "bought_next", "bought_next_copies")


@query("join_by_key", """SELECT o.o_orderkey, o.o_orderstatus, l.n, l.qty FROM orders o JOIN (
  SELECT l_orderkey AS o_orderkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) l USING (o_orderkey)""")
def join_by_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
    return R.align(o, li, ["o_orderkey"])


@query("enrich_location", """SELECT s.s_suppkey, s.s_name, coalesce(n.n_regionkey, -1) AS n_regionkey,
  coalesce(n.r_name, 'NOWHERE') AS r_name
FROM (SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN 'unknown' ELSE 'nation_' || s_nationkey::VARCHAR END AS place FROM supplier) s
LEFT JOIN (SELECT n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) n
  ON lower(n.n_name) = lower(s.place)""")
def enrich_location(spark, sf_dir):
    dim = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, sf_dir, "supplier").withColumn(
        "place", F.when(F.col("s_acctbal") < 0, "unknown").otherwise(F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"))))
    out = R.enrich(s, "place", dim, "n_name", ["n_regionkey", "r_name"], {"n_regionkey": -1, "r_name": "NOWHERE"})
    return out.select("s_suppkey", "s_name", "n_regionkey", "r_name")


@query("known_entities", """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def known_entities(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return R.known_entities(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", known, "c_custkey")


# ---- shifts ----------------------------------------------------------------------

_LEADS = [(v, k) for v in [*DAY_MEASURES, "rain_today"] for k in (1, 2, 3)]


@query("lead_targets", f"WITH {DAILY} SELECT station, d, " + ", ".join(
    f"lead({v}, {k}) OVER (PARTITION BY station ORDER BY d) AS {v}_day_{k}" for v, k in _LEADS) + " FROM daily")
def lead_targets(spark, sf_dir):
    out = L.lead_targets(daily(spark, sf_dir), "station", ["d"], [*DAY_MEASURES, "rain_today"])
    return out.select("station", "d", *[f"{v}_day_{k}" for v, k in _LEADS])


@query("lead_targets_rows", "SELECT event_id, user_id, " + ", ".join(
    f"lead(value, {k}) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) AS value_day_{k}" for k in (1, 2, 3))
    + " FROM events")
def lead_targets_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("d"), "value")
    return L.lead_targets(ev, "user_id", ["d", "event_id"], ["value"], block_days=2).drop("d", "value")


@query("supplier_leads", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d,
  lead(l_quantity, 1) OVER w AS quantity_day_1, lead(l_quantity, 3) OVER w AS quantity_day_3 FROM lineitem
WINDOW w AS (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber, l_partkey)""")
def supplier_leads(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_quantity").alias("quantity"))
    out = L.lead_targets(li, "l_suppkey", ["d", "l_orderkey", "l_linenumber", "l_partkey"], ["quantity"], (1, 3))
    return out.drop("quantity")


@query("diff_stats", f"""WITH {DAILY}, p AS (
  SELECT station, total - lag(total) OVER w AS total, top - lag(top) OVER w AS top FROM daily
  WINDOW w AS (PARTITION BY station ORDER BY d)),
u AS (SELECT station, 'total' AS variable, total AS step FROM p UNION ALL SELECT station, 'top', top FROM p)
SELECT station, variable, count(step) AS n_pairs, round(avg(step), 8) AS mean_step,
  round(CASE WHEN stddev_pop(step) = 0 THEN 0.5 ELSE stddev_pop(step) END, 8) AS std_step
FROM u GROUP BY 1, 2""")
def diff_stats(spark, sf_dir):
    out = L.diff_stats(daily(spark, sf_dir), "station", ["d"], ["total", "top"], block_days=7)
    return rounded(out, "mean_step", "std_step", digits=8)


@query("carry_label", f"""WITH {DAILY}, t AS (SELECT station, d, rain_today,
  CASE WHEN top > 100 THEN 'Yes' ELSE 'No' END AS rain_tomorrow FROM daily)
SELECT station, d, coalesce(lag(rain_tomorrow) OVER (PARTITION BY station ORDER BY d), rain_today) AS rain_today FROM t""")
def carry_label(spark, sf_dir):
    t = daily(spark, sf_dir).withColumn("rain_tomorrow", F.when(F.col("top") > 100, "Yes").otherwise("No"))
    return L.carry_label(t, "station", ["d"], "rain_tomorrow", "rain_today", block_days=7).select("station", "d", "rain_today")


@query("first_n_per_entity", f"""WITH {DAILY} SELECT station, d, total FROM (
  SELECT *, row_number() OVER (PARTITION BY station ORDER BY d) AS rn FROM daily) WHERE rn <= 3""")
def first_n_per_entity(spark, sf_dir):
    return L.first_n(daily(spark, sf_dir), "station", ["d"], 3).select("station", "d", "total")


@query("cumulative_share", """WITH c AS (SELECT l_linenumber AS part, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1),
s AS (SELECT part, v / (SELECT sum(v) FROM c) AS share FROM c)
SELECT part, round(share, 6) AS share, round(sum(share) OVER (ORDER BY part), 6) AS cumulative FROM s""")
def cumulative_share(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("part")).agg(F.sum("l_extendedprice").alias("v"))
    total = c.agg(F.sum("v").alias("t")).scalar()
    s = c.select("part", (F.col("v") / total).alias("share"))
    return rounded(L.cumulative(s, "part", "share", "cumulative"), "share", "cumulative", digits=6)


@query("top3_features", """WITH m AS (SELECT l_returnflag AS g, avg(l_quantity) AS quantity, avg(l_discount) * 1000 AS discount,
  avg(l_tax) * -1000 AS tax, avg(l_linenumber) AS linenumber FROM lineitem GROUP BY 1),
u AS (SELECT g, 'quantity' AS feature, quantity AS v FROM m UNION ALL SELECT g, 'discount', discount FROM m
  UNION ALL SELECT g, 'tax', tax FROM m UNION ALL SELECT g, 'linenumber', linenumber FROM m),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY g ORDER BY abs(v) DESC, feature) AS INTEGER) AS "rank" FROM u)
SELECT g, feature, round(v, 4) AS v, "rank" FROM r WHERE "rank" <= 3""")
def top3_features(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("g")).agg(
        F.avg("l_quantity").alias("quantity"), (F.avg("l_discount") * 1000).alias("discount"),
        (F.avg("l_tax") * -1000).alias("tax"), F.avg("l_linenumber").alias("linenumber"))
    u = m.unpivot(["g"], ["quantity", "discount", "tax", "linenumber"], "feature", "v")
    return rounded(L.top_k(u, ["g"], "feature", "v"), "v")


@query("entity_rank", """SELECT station, total, rank() OVER (ORDER BY total DESC) AS "rank" FROM (
  SELECT user_id AS station, round(sum(value), 0) AS total FROM events GROUP BY 1)""")
def entity_rank(spark, sf_dir):
    t = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("station")).agg(F.round(F.sum("value"), 0).alias("total"))
    return L.rank_by(t, "total")


@query("order_rank_in_priority", """SELECT o_orderkey, o_orderpriority,
  rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS "rank" FROM orders""")
def order_rank_in_priority(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return L.rank_by(o, "o_totalprice", desc=False, by="o_orderpriority").drop("o_totalprice")


@query("sorted_by_entity_date", "SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderkey FROM orders ORDER BY 1, 2, 3")
def sorted_by_entity_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderkey")
    return L.sort_limit(o, ["o_custkey", "d", "o_orderkey"])


@query("top1_latest", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def top1_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return L.sort_limit(o, [F.desc("d"), F.desc("o_orderkey")], 1)


# ---- splits ----------------------------------------------------------------------

@query("positional_split", f"""WITH {DAILY}, r AS (SELECT *, row_number() OVER (ORDER BY station, d) AS rn, count(*) OVER () AS n FROM daily)
SELECT station, d, CAST(rn <= floor(n * (1 - CAST(0.2 AS DOUBLE))) AS INTEGER) AS is_train FROM r""")
def positional_split(spark, sf_dir):
    t = daily(spark, sf_dir).withColumn("one", F.lit(1))
    return L.positional_split(t, "station", "d", "one").select("station", "d", "is_train")


@query("positional_split_events", """WITH r AS (SELECT event_id, row_number() OVER (ORDER BY user_id, CAST(ts AS DATE), event_id) AS rn,
  count(*) OVER () AS n FROM events)
SELECT event_id, CAST(rn <= floor(n * (1 - CAST(0.2 AS DOUBLE))) AS INTEGER) AS is_train FROM r""")
def positional_split_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("d"))
    return L.positional_split(ev, "user_id", "d", "event_id").select("event_id", "is_train")


# ---- reshape ---------------------------------------------------------------------

@query("unpivot_onehot", "SELECT o_orderkey, o_orderpriority AS priority FROM orders")
def unpivot_onehot(spark, sf_dir):
    from obsledger.operators.clean import one_hot
    hot = one_hot(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")
    return R.melt_onehot(hot, "o_orderpriority_", ["o_orderkey"], "priority")


@query("concat_rows", """SELECT c_custkey AS id, c_acctbal AS bal, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""")
def concat_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.lit("customer").alias("kind"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"), F.lit("supplier").alias("kind"))
    return R.concat_rows(c, s)


_FIELDS = {"min_temp": "top", "max_temp": "total"}


def _forecast(spark, sf_dir):
    """Each user's first three days as a stored forecast, nested per user."""
    three = L.first_n(daily(spark, sf_dir), "station", ["d"], 3)
    return R.nest_forecast(three, "station", "d", _FIELDS, "rain_today")


_NESTED = f"""{DAILY}, three AS (SELECT station AS location, strftime(d, '%Y-%m-%d') AS date,
  CAST(round(CAST(top AS DECIMAL(18, 2)), 1) AS DOUBLE) AS min_temp,
  CAST(round(CAST(total AS DECIMAL(18, 2)), 1) AS DOUBLE) AS max_temp, rain_today AS rain_forecast, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY station ORDER BY d) AS rn FROM daily) WHERE rn <= 3)"""


@query("nest_forecast", f"""WITH {_NESTED} SELECT location, string_agg(date || ' ' || rain_forecast, ',' ORDER BY date) AS days,
  count(*) AS n_days, round(sum(max_temp), 4) AS max_temp FROM three GROUP BY 1""")
def nest_forecast(spark, sf_dir):
    word = F.transform("days", lambda x: F.concat_ws(" ", x["date"], x["rain_forecast"]))
    total = F.aggregate("days", F.lit(0.0), lambda a, x: a + x["max_temp"])
    return _forecast(spark, sf_dir).select(
        "location", F.array_join(word, ",").alias("days"), F.size("days").cast("long").alias("n_days"),
        F.round(total, 4).alias("max_temp"))


@query("unnest_forecast", f"WITH {_NESTED} SELECT location, date, min_temp, max_temp, rain_forecast FROM three")
def unnest_forecast(spark, sf_dir):
    return R.unnest_forecast(_forecast(spark, sf_dir))


@query("latest_version", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS version FROM orders
WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def latest_version(spark, sf_dir):
    return R.latest_version(table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("version")))


@query("latest_forecast", """WITH f AS (SELECT o_orderpriority AS forecast_id, o_orderdate AS generated_at, o_orderkey FROM orders)
SELECT forecast_id, o_orderkey FROM f
WHERE forecast_id = (SELECT forecast_id FROM f ORDER BY generated_at DESC, forecast_id DESC LIMIT 1)""")
def latest_forecast(spark, sf_dir):
    f = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("forecast_id"), F.col("o_orderdate").alias("generated_at"), "o_orderkey")
    return R.latest_forecast(f).select("forecast_id", "o_orderkey")


@query("parquet_roundtrip", """SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS version FROM orders
WHERE year(o_orderdate) >= 2000""")
def parquet_roundtrip(spark, sf_dir):
    """Write a partitioned table to the shared folder and read two of its partitions back."""
    from obsledger.session import checkpoint_dir
    from obsledger.sources.files import read_table, write_table
    path = f"{checkpoint_dir(spark)}/orders-by-year-{uuid.uuid4()}"
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("version"))
    write_table(o, path, partition_by=["version"])
    return read_table(spark, path).where("version >= 2000")


@query("csv_roundtrip", """SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer""")
def csv_roundtrip(spark, sf_dir):
    """Write a CSV table whose missing values read NA, and read it with a given schema."""
    from obsledger.session import checkpoint_dir
    from obsledger.sources.files import read_observations, write_table
    path = f"{checkpoint_dir(spark)}/customers-{uuid.uuid4()}"
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    write_table(c.select(*[F.coalesce(F.col(n).cast("string"), F.lit("NA")).alias(n) for n in c.columns]), path, "csv")
    return read_observations(spark, path, c.schema)


@query("json_roundtrip", """SELECT o_custkey, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
FROM orders GROUP BY o_custkey""")
def json_roundtrip(spark, sf_dir):
    """Write one JSON document per customer and day with its orders, read the documents and sum what they hold."""
    from obsledger.session import checkpoint_dir
    from obsledger.sources.files import read_doc, write_doc
    path = f"{checkpoint_dir(spark)}/order-documents-{uuid.uuid4()}"
    o = table(spark, sf_dir, "orders")
    docs = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(
        F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("orders"))  # one customer's orders of one day
    write_doc(docs, path)
    lines = read_doc(spark, path, docs.schema).select("o_custkey", F.explode("orders").alias("o"))
    cents = F.round(F.col("o.o_totalprice") * 100).cast("long")
    return lines.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents"))


@query("hash_split_whole", "SELECT o_orderkey, CAST(1 AS BIGINT) AS n, true AS one_side FROM orders")
def hash_split_whole(spark, sf_dir):
    """Both sides of the hashed split together: every order once, on one side, also after other partitions."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = L.hash_split(o, ["o_orderkey"])
    again, _ = L.hash_split(o.repartition(7), ["o_orderkey"])
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    moved = again.withColumn("side", F.lit("train")).withColumn("new", F.lit(0))
    both = sides.withColumn("new", F.lit(1)).unionByName(moved)
    return both.groupBy("o_orderkey").agg(F.sum("new").alias("n"), (F.count_distinct("side") == 1).alias("one_side"))


@query("one_hot_index", """SELECT p_partkey, p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS place FROM part""")
def one_hot_index(spark, sf_dir):
    from obsledger.operators.clean import one_hot_index as index
    return index(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "place")


@query("dedup_columns", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def dedup_columns(spark, sf_dir):
    from obsledger.operators.clean import dedup_columns as dedup
    s = table(spark, sf_dir, "supplier")
    return dedup(s.select("s_suppkey", "s_name", "s_acctbal", F.lit(0).alias("s_name"), F.lit("x").alias("s_suppkey")))


@query("params_roundtrip", """SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS class, count(*) AS n,
  round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1""")
def params_roundtrip(spark, sf_dir):
    """Fit naive Bayes, store its parameters, load them and return them."""
    from obsledger.models.bayes import fit_bayes
    from obsledger.session import checkpoint_dir
    from obsledger.sources.files import load_params, save_model
    path = f"{checkpoint_dir(spark)}/bayes-{uuid.uuid4()}"
    o = table(spark, sf_dir, "orders").select("o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("late"))
    save_model(fit_bayes(o, ["o_totalprice"], "late"), path)
    return load_params(spark, path).select("class", "n", F.round(F.col("mean")[0], 4).alias("mean"))
