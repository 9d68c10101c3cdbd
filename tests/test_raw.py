import pytest
from pyspark.sql import types as T

from lakestar.operators import ExpectationError
from lakestar.sources import flatten_checked, load_checked, table_exists
from lakestar.sources.raw import quarantine_table

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("s", T.StringType())])
CASES = [('{"id": 1, "v": 1.5, "s": "a"}', None), ('{"id": 2}', None), ('{}', None), ('{"id": null, "other": [1]}', None),
         ('{"id": 3, "v": "n/a"}', "mistyped"), ('{"id": "x"}', "mistyped"), ('{"id": 4, "v"', "malformed"), ("", "malformed"),
         ("[1, 2]", "malformed"), ("no json", "malformed"), (None, "missing"), ('{"id": 5, "s": {"a": 1}}', None)]


def frame(spark, cases):
    return spark.createDataFrame([(t,) for t, _ in cases], "_raw string")


def test_reasons(spark):
    got = {r._raw: r._reason for r in flatten_checked(frame(spark, CASES), SCHEMA).collect()}
    assert got == dict(CASES)


def test_both_branches_come_from_one_parse(spark, warehouse):
    rows = CASES + CASES[6:7] * 4
    typed, bad = load_checked(frame(spark, rows), SCHEMA, "t_checked", max_share=0.9)
    assert typed.columns == ["id", "v", "s"] and typed.count() == sum(r is None for _, r in rows)
    assert {(r.text, r.reason): r.n for r in bad.collect()} == {c: rows.count(c) for c in rows if c[1]}


def test_too_many_corrupt_rows_publish_nothing(spark, warehouse):
    with pytest.raises(ExpectationError):
        load_checked(frame(spark, CASES), SCHEMA, "t_stopped", max_share=0.5)
    assert not table_exists(spark, "t_stopped") and not table_exists(spark, quarantine_table("t_stopped"))
    typed, bad = load_checked(frame(spark, []), SCHEMA, "t_none")
    assert typed.count() == bad.count() == 0
