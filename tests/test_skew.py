"""Skewed inputs: a key, a range or a season holding a third of all rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

import lakestar.operators.ordered as ordered
from lakestar.operators import dense_keys, latest_per_key, season_totals


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 7 % 1000).alias("ts"), F.col("id").alias("tie"))
    got = latest_per_key(df, ["k"], ["ts"], ["tie"])
    want = df.groupBy("k").agg(F.max(F.struct("ts", "tie")).alias("m")).select("k", "m.ts", "m.tie")
    assert got.count() == want.count()
    assert got.select("k", "ts", "tie").exceptAll(want).count() == 0


def test_range_buckets_stay_balanced_when_keys_cluster(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # a third of the keys crowd into a range 1000x narrower than the rest
        df = spark.range(0, 24000).select(
            F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 1000).alias("k"))
        sizes = [r["count"] for r in ordered.range_buckets(df, [("k", True)]).groupBy(ordered.BUCKET).count().collect()]
        assert len(sizes) >= 8 and max(sizes) <= 2 * (24000 / 8)
        got = dense_keys(df, ["k"], "key")
        want = df.withColumn("key", F.row_number().over(Window.orderBy("k")).cast("bigint"))
        assert got.exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_season_totals_with_a_dominant_competitor(spark):
    rep = spark.range(0, 9000).select(
        F.lit(2020).alias("race_year"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("who"),
        F.lit(1.0).alias("points"), (F.col("id") % 2).alias("position_order"))
    t = season_totals(rep, "race_year", "who", "points", F.col("position_order") == 1)
    hot = t.where("competitor = 'hot'").collect()[0]
    assert float(hot["total_points"]) == 3000.0 and hot["wins"] == 1500
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2  # partial aggregation before the shuffle
