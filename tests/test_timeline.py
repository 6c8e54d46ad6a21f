import datetime as dt

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsledger.operators import timeline as L


@pytest.fixture(scope="module")
def walk(spark):
    """Unevenly spread rows: one station holds most of them, days repeat and are skipped."""
    return spark.range(600).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("e"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 17 % 90).cast("int")).alias("d"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 31 % 57).cast("double")).alias("v"))


@pytest.mark.parametrize("days", [1, 2, 7, 32, 1000])
def test_shift_equals_plain_window(spark, walk, days):
    w = W.partitionBy("e").orderBy("d", "k")
    shifts = {"a": ("v", 1), "b": ("v", 3), "c": ("v", -2)}
    want = walk.withColumns({"a": F.lead("v", 1).over(w), "b": F.lead("v", 3).over(w), "c": F.lag("v", 2).over(w)})
    got = L.shifted(walk, "e", ["d", "k"], shifts, days)
    assert got.count() == want.count()
    assert got.select(want.columns).exceptAll(want).isEmpty()


@pytest.mark.parametrize("rows", [1, 8, 300])
def test_shift_with_a_dense_entity(spark, walk, rows):
    # limits small enough to force one-day blocks and then sorted ranges
    w = W.partitionBy("e").orderBy("d", "k")
    want = walk.withColumns({"a": F.lead("v", 2).over(w), "c": F.lag("v", 1).over(w)})
    got = L.shifted(walk, "e", ["d", "k"], {"a": ("v", 2), "c": ("v", -1)}, block_rows=rows)
    assert got.count() == want.count() and got.select(want.columns).exceptAll(want).isEmpty()


def test_shift_same_on_any_partitioning(spark, walk):
    a = L.lead_targets(walk.repartition(1), "e", ["d", "k"], ["v"], block_days=5)
    b = L.lead_targets(walk.repartition(7), "e", ["d", "k"], ["v"], block_days=5)
    assert a.exceptAll(b).isEmpty()


def test_next_day_needs_the_next_date(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), "No"), ("a", dt.date(2024, 1, 2), "Yes"), ("a", dt.date(2024, 1, 4), "No")],
                               "e string, d date, r string")
    got = {r["d"].day: r["n"] for r in L.next_day_label(df, "e", "d", "r", "n").collect()}
    assert got == {1: "Yes", 2: None, 4: None}


def test_next_day_with_repeated_days(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), "No"), ("a", dt.date(2024, 1, 2), "No"),
                                ("a", dt.date(2024, 1, 2), "Yes"), ("a", dt.date(2024, 1, 2), "No")], "e string, d date, r string")
    any_ = L.next_day_label(df, "e", "d", "r", "n")
    assert any_.count() == 4 and any_.where("d = '2024-01-01'").first()["n"] == "Yes"
    each = L.next_day_label(df, "e", "d", "r", "n", repeats="each").where("d = '2024-01-01'")
    assert {(r["n"], r["n_copies"]) for r in each.collect()} == {("Yes", 1), ("No", 2)}


def test_diff_stats_constant_series_gets_the_floor(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, i), 2.0 * i) for i in (1, 2, 3, 4)], "e string, d date, v double")
    r = L.diff_stats(df, "e", ["d"], ["v"]).first()
    assert (r["n_pairs"], r["mean_step"], r["std_step"]) == (3, 2.0, 0.5)


def test_first_n_and_top_k(spark, walk):
    assert L.first_n(walk, "e", ["d", "k"], 2).groupBy("e").count().agg(F.max("count")).first()[0] == 2
    plan = L.first_n(walk, "e", ["d", "k"], 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan  # rows are cut before the shuffle


@pytest.mark.parametrize("by", [None, "e"])
@pytest.mark.parametrize("desc", [True, False])
def test_rank_equals_window_rank(spark, walk, by, desc):
    w = (W.partitionBy(by) if by else W.partitionBy()).orderBy(F.desc("v") if desc else F.asc("v"))
    want = walk.where("v IS NOT NULL").withColumn("rank", F.rank().over(w))
    got = L.rank_by(walk, "v", desc=desc, by=by)
    assert got.count() == walk.count()
    assert got.where("v IS NOT NULL").select(want.columns).exceptAll(want.withColumn("rank", F.col("rank").cast("long"))).isEmpty()


@pytest.mark.parametrize("limit", [2, 10**6])
def test_positional_split_matches_row_numbers(spark, walk, limit):
    out = L.positional_split(walk, "e", "d", "k", 0.2, max_rows=limit)
    w = W.orderBy("e", "d", "k")
    want = walk.withColumn("is_train", (F.row_number().over(w) <= int(600 * 0.8)).cast("int"))
    assert out.select(want.columns).exceptAll(want).isEmpty() and out.where("is_train = 1").count() == 480


def test_hash_split_is_a_stable_partition(spark, walk):
    train, test = L.hash_split(walk, ["k"])
    train2, _ = L.hash_split(walk.repartition(9), ["k"])
    assert train.count() + test.count() == 600 and train.join(test, "k").isEmpty()
    assert train.exceptAll(train2).isEmpty() and 70 < test.count() < 170


def test_sample_rows_takes_one_share_at_every_size(spark, walk):
    assert 120 < L.sample_rows(walk, ["k"], 0.3).count() < 240
    small = walk.where("k < 300")
    assert L.sample_rows(small, ["k"], 0.3).exceptAll(L.sample_rows(walk, ["k"], 0.3)).isEmpty()


@pytest.mark.parametrize("limit", [10**6, 20])
def test_positional_split_orders_missing_values_first(spark, walk, limit):
    holes = walk.select(F.when(F.col("k") % 2 > 0, F.col("e")).alias("e"), F.when(F.col("k") % 3 > 0, F.col("d")).alias("d"), "k")
    w = W.orderBy("e", "d", "k")
    for test_size in (0.2, 0.55, 0.9):
        out = L.positional_split(holes, "e", "d", "k", test_size, max_rows=limit)
        want = holes.withColumn("is_train", (F.row_number().over(w) <= int(600 * (1 - test_size))).cast("int"))
        assert out.select(want.columns).exceptAll(want).isEmpty() and out.count() == 600


def test_carry_label(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), "No", "Yes"), ("a", dt.date(2024, 1, 2), "No", "No")],
                               "e string, d date, today string, tomorrow string")
    got = [r["today"] for r in L.carry_label(df, "e", ["d"], "tomorrow", "today").orderBy("d").collect()]
    assert got == ["No", "Yes"]
