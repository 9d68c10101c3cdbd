import pytest

from lakestar.operators import (DistinctEquals, ExpectationError, InSetOf, LengthBetween, NotNull,
                                Unique, ValueBetween, check, evaluate)


def _by_rule(df):
    return {(r["rule_name"], r["column"]): r for r in df.collect()}


def test_row_rules_one_pass_and_null_handling(spark):
    df = spark.createDataFrame([(1, 123.4), (2, None), (None, 45.0)], "id int, lat double")
    res = _by_rule(evaluate(df, [NotNull("id"), ValueBetween("lat", -90, 90), LengthBetween("lat", -90, 90)]))
    assert res[("not_null", "id")]["n_bad"] == 1
    # latitude 123.4: the value rule fails, the length rule passes; NULL ignored
    assert res[("value_between", "lat")]["n_bad"] == 1
    assert res[("length_between", "lat")]["n_bad"] == 0
    assert all(r["n_rows"] == 3 for r in res.values())


def test_distinct_equals_missing_season(spark):
    years = spark.createDataFrame([(y,) for y in [2021, 2021, 2023]], "year int")
    r = evaluate(years, [DistinctEquals("year", [2021, 2022, 2023])]).collect()[0]
    assert r["n_bad"] == 1 and r["success"] is False
    with pytest.raises(ExpectationError):
        check(years, [DistinctEquals("year", [2021, 2022, 2023])])


def test_reference_unknown_status(spark):
    results = spark.createDataFrame([(1,), (2,), (99,), (None,)], "statusid int")
    status = spark.createDataFrame([(1,), (2,), (3,)], "statusid int")
    r = evaluate(results, [InSetOf("statusid", status)]).collect()[0]
    assert r["n_bad"] == 1 and r["n_rows"] == 4


def test_unique_counts_duplicated_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert evaluate(df, [Unique("a", "b")]).collect()[0]["n_bad"] == 2


def test_enforce_passes_clean_data(spark):
    df = spark.createDataFrame([(1,)], "id int")
    report = check(df, [NotNull("id")])
    assert report[0]["success"] is True


def test_a_gated_silver_job_scans_its_raw_rows_once(spark):
    from pyspark.sql import types as T
    from lakestar.operators import ExpectationError, InSetOf, NotNull
    from lakestar.plans.entities import EntitySpec, gated_newest
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType()),
                           T.StructField("updated_at", T.LongType())])
    rows = [f'{{"id": {i % 40}, "status": "s{i % 3}", "updated_at": {i}}}' for i in range(120)] + ['{"id": 99, "updated_at": 1}']
    scanned = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            scanned.add(len(batch))
            yield batch

    raw = spark.createDataFrame([(r,) for r in rows], "_raw string").mapInPandas(count, "_raw string")
    spec = EntitySpec("t_once", schema, ["id"], rules=[NotNull("id")])
    known = spark.createDataFrame([("s0",), ("s1",), ("s2",), ("s2",), (None,)], "name string")
    out = gated_newest(raw, spec, extra_rules=[InSetOf("status", known, "name")])
    assert sorted(r.id for r in out.collect()) == [*range(40), 99] and scanned.value == len(rows)
    assert set(out.columns) == {"id", "status", "updated_at", "_raw_hash"}
    with pytest.raises(ExpectationError) as e:
        gated_newest(raw, spec, extra_rules=[InSetOf("status", known.where("name <> 's1'"), "name")])
    assert [(f["rule_name"], f["column"], f["n_bad"], f["n_rows"]) for f in e.value.failed] == [("in_set_of", "status", 40, 121)]
    assert scanned.value == 2 * len(rows)
