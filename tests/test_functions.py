import datetime as dt

from pyspark.sql import types as T

from lakestar.functions import (assemble_datetime, join_text, rename, sentinel_to_null,
                                try_cast_columns)
from lakestar.sources import flatten_json, pack_json

SCHEMA = T.StructType([T.StructField("driverid", T.IntegerType()), T.StructField("number", T.StringType()),
                       T.StructField("code", T.StringType())])


def test_flatten_edge_rows(spark):
    raw = spark.createDataFrame([("not json",), ('{"driverid": "x"}',), ('{"driverid": 2}',),
                                 ('{"driverid": 3, "number": 44}',)], "_raw string")
    rows = flatten_json(raw, SCHEMA, corrupt_col="_corrupt").collect()
    assert rows[0]["driverid"] is None and rows[0]["_corrupt"] == "not json"
    assert rows[1]["driverid"] is None and rows[1]["_corrupt"] == '{"driverid": "x"}'
    assert rows[2]["driverid"] == 2 and rows[2]["number"] is None and rows[2]["_corrupt"] is None
    assert rows[3]["number"] == "44"


def test_pack_then_flatten_roundtrip_keeps_microseconds(spark):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    df = spark.createDataFrame([(1, ts)], "id long, ts timestamp_ntz")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    back = flatten_json(pack_json(df), schema).collect()[0]
    assert back["ts"] == ts


def test_sentinel_and_try_cast(spark):
    df = spark.createDataFrame([("\\N", "\\N", "12m"), ("44", "HAM", "7")], "number string, code string, alt string")
    out = try_cast_columns(sentinel_to_null(df, ["number", "code"]), {"number": "int", "alt": "int"}).collect()
    assert out[0]["number"] is None and out[0]["code"] is None and out[0]["alt"] is None
    assert out[1]["number"] == 44 and out[1]["alt"] == 7
    # a sentinel in a column not listed for replacement is NULL, not an error
    assert try_cast_columns(df, {"number": "int"}).collect()[0]["number"] is None


def test_assemble_datetime_cases(spark):
    df = spark.createDataFrame([
        (dt.date(1950, 5, 13), None), (None, "14:00:00"), (None, None), (dt.date(2023, 3, 5), "15:00:00"),
        (dt.date(2023, 3, 5), "25:99")], "d date, t string")
    got = [r[0] for r in df.select(assemble_datetime("d", "t")).collect()]
    assert got == [dt.datetime(1950, 5, 13), None, None, dt.datetime(2023, 3, 5, 15), None]


def test_join_text_null_if_any_part_null(spark):
    df = spark.createDataFrame([("Lewis", "Hamilton"), ("Max", None)], "f string, s string")
    assert [r[0] for r in df.select(join_text("f", "s")).collect()] == ["Lewis Hamilton", None]


def test_rename_is_simultaneous_and_strict(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = rename(df, {"a": "b", "b": "a"})
    assert out.columns == ["b", "a"] and out.collect()[0]["b"] == 1
    import pytest
    with pytest.raises(ValueError):
        rename(df, {"a": "b"})
    with pytest.raises(ValueError):
        rename(df, {"zz": "y"})
