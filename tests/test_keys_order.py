"""Range-bucketed global numbering must equal the single-task window."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestar.operators import dense_keys, global_number, hash_key


@pytest.fixture()
def many_buckets(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dense_keys_numeric_equals_row_number(spark, many_buckets):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"))
    got = dense_keys(df, ["k"], "key")
    want = df.withColumn("key", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dense_keys_string_and_start(spark, many_buckets):
    df = spark.range(0, 3000).select(F.concat(F.lit("s"), (F.col("id") * 31 % 3001).cast("string")).alias("k"))
    got = dense_keys(df, ["k"], "key", start=101)
    want = df.withColumn("key", (F.row_number().over(Window.orderBy("k")) + 100).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dense_keys_descending_with_nulls(spark, many_buckets):
    df = spark.range(0, 2000).select(F.when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 500 * 3 + F.col("id") / 10000).alias("k"))
    got = global_number(df, [("k", False)], "n")
    want = df.withColumn("n", F.row_number().over(Window.orderBy(F.col("k").desc())).cast("bigint"))
    # ties are impossible except among NULLs; compare the multiset of (k, n) for non-NULL k
    g = got.where("k is not null")
    w = want.where("k is not null")
    assert g.exceptAll(w).count() == 0
    assert got.select("n").distinct().count() == 2000


def test_rank_partitioned_equals_window_rank(spark, many_buckets):
    df = spark.range(0, 4000).select((F.col("id") % 5).alias("year"), (F.col("id") * 13 % 50).alias("pts"),
                                     (F.col("id") % 3).alias("wins"))
    got = global_number(df, [("pts", False), ("wins", False)], "rk", partition_cols=["year"], method="rank")
    w = Window.partitionBy("year").orderBy(F.col("pts").desc(), F.col("wins").desc())
    want = df.withColumn("rk", F.rank().over(w).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=300, unique=True))
def test_dense_keys_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k long").repartition(5)
    got = {r["k"]: r["key"] for r in dense_keys(df, ["k"], "key").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_hash_key_matches_md5_text(spark):
    df = spark.createDataFrame([(1,), (22,)], "c long")
    got = [r[0] for r in df.select(hash_key("c")).collect()]
    import hashlib
    assert got == [hashlib.md5(b"1").hexdigest(), hashlib.md5(b"22").hexdigest()]


def test_standings_with_hot_tied_score_equals_window_rank(spark, many_buckets):
    from lakestar.operators import standings
    # a third of the competitors share the score (0 points, 0 wins)
    df = spark.range(0, 3000).select(
        (F.col("id") % 4).cast("bigint").alias("race_year"), F.col("id").cast("string").alias("competitor"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7 % 97).cast("decimal(18,2)").alias("total_points"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).cast("bigint").alias("wins"))
    got = standings(df)
    w = Window.partitionBy("race_year").orderBy(F.col("total_points").desc(), F.col("wins").desc())
    want = df.withColumn("season_rank", F.rank().over(w).cast("bigint"))
    assert got.count() == 3000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hash_key_of_several_columns_is_injective(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("~", "c"), ("1:a", None), ("1", "a"), ("", None), (None, "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(hash_key("x", "y").alias("h")).distinct().count() == len(rows)
