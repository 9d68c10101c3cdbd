import pytest
from pyspark.sql import functions as F

from lakestar.operators import UpsertKeyError, dense_keys, upsert, upsert_with_key


def _rows(df, key="id"):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: t[df.columns.index(key)])


def test_full_row_upsert_null_overwrites(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, v double")
    s = spark.createDataFrame([(2, "b2", None), (3, "c", 3.0)], "id int, name string, v double")
    assert _rows(upsert(t, s, ["id"])) == [(1, "a", 1.0), (2, "b2", None), (3, "c", 3.0)]


def test_key_only_merge_matches_literal_behaviour(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, v double")
    s = spark.createDataFrame([(2, "b2", None), (3, "c", 3.0)], "id int, name string, v double")
    out = upsert(t, s, ["id"], update_cols=[], insert_cols=["id"])
    assert _rows(out) == [(1, "a", 1.0), (2, "b", 2.0), (3, None, None)]


def test_duplicate_or_null_source_key_is_an_error(spark):
    t = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(UpsertKeyError):
        upsert(t, spark.createDataFrame([(2, "x"), (2, "y")], "id int, name string"), ["id"])
    with pytest.raises(UpsertKeyError):
        upsert(t, spark.createDataFrame([(None, "x")], "id int, name string"), ["id"])


def test_upsert_is_idempotent(spark):
    t = spark.range(0, 200).select(F.col("id").cast("int").alias("id"), (F.col("id") * 2).alias("v"))
    s = spark.range(150, 260).select(F.col("id").cast("int").alias("id"), (F.col("id") * 3).alias("v"))
    once = upsert(t, s, ["id"])
    twice = upsert(once, s, ["id"])
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.count() == 260


def test_upsert_with_key_keeps_keys_and_appends_new(spark):
    t = dense_keys(spark.createDataFrame([(10, "a"), (20, "b"), (30, "c")], "id int, name string"), ["id"], "k") \
        .select("k", "id", "name")
    s = spark.createDataFrame([(20, "b2"), (25, "n1"), (5, "n0")], "id int, name string")
    out = upsert_with_key(t, s, ["id"], "k")
    got = {r["id"]: (r["k"], r["name"]) for r in out.collect()}
    assert got == {10: (1, "a"), 20: (2, "b2"), 30: (3, "c"), 5: (4, "n0"), 25: (5, "n1")}
    # a second identical batch changes nothing, keys included
    again = upsert_with_key(out, s, ["id"], "k")
    assert out.exceptAll(again).count() == 0 and again.exceptAll(out).count() == 0


def test_composite_key_upsert(spark):
    t = spark.createDataFrame([(1, "sprint", 5), (1, "full_race", 6)], "k long, tag string, v int")
    s = spark.createDataFrame([(1, "sprint", 7), (2, "sprint", 8)], "k long, tag string, v int")
    out = sorted(tuple(r) for r in upsert(t, s, ["k", "tag"]).collect())
    assert out == [(1, "full_race", 6), (1, "sprint", 7), (2, "sprint", 8)]


def test_delete_keys_remove_rows_absent_from_source(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    s = spark.createDataFrame([(2, "b2")], "id int, name string")
    gone = spark.createDataFrame([(2,), (3,)], "id int")
    assert _rows(upsert(t, s, ["id"], delete_keys=gone)) == [(1, "a"), (2, "b2")]
