"""Incremental refresh of the synthetic result tables, their facts and
their report rows equals a full rebuild on all raw rows."""

from pyspark.sql import functions as F

from lakestar.plans.entities import silver_frame
from lakestar.plans.star import RACE_RESULT, SPRINT_RESULT, StarPipeline, pack_results
from lakestar.session import scratch_path
from lakestar.sources import pack_json, read

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_results_equal_full_rebuild(spark):
    spark.conf.set("lakestar.warehouse", scratch_path(spark, "wh-incr"))
    try:
        p = StarPipeline(spark, SF)
        p.publish(num_buckets=4)
        li = spark.read.parquet(f"{SF}/lineitem.parquet")
        # new versions of ~5% of the lines: newer shipdate, flipped line status
        changed = li.sample(fraction=0.05, seed=3).withColumn(
            "l_shipdate", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")) \
            .withColumn("l_linestatus", F.when(F.col("l_linestatus") == "F", "O").otherwise("F")) \
            .withColumn("l_quantity", F.col("l_quantity") + 1)
        out = p.refresh_results(changed, num_buckets=4)
        allrows = li.unionByName(changed)
        everything = pack_results(allrows)
        for entity, spec in (("race_result", RACE_RESULT), ("sprint_result", SPRINT_RESULT)):
            want = silver_frame(everything, spec, run_gate=False)
            got = out[entity]
            cols = [c for c in want.columns if c != spec.key_col and c != "updated_at"]
            assert _same(got.select(*cols), want.select(*cols)), entity
            assert got.select(spec.key_col).distinct().count() == got.count()

        # the whole synthetic pipeline rebuilt lazily on all raw rows
        full = StarPipeline(spark, SF)
        full.__dict__["raw_result"] = everything
        full.__dict__["raw_status"] = pack_json(allrows, {
            "statusname": F.concat("l_returnflag", "l_linestatus"), "updated_at": "l_shipdate"})
        cols = ["result_key", "race_type", "race_year", "race_date", "circuit_name", "circuit_country",
                "driver_fullname", "constructor_name", "status_name", "position_order", "points"]
        assert _same(read(spark, "gold_report_result").select(*cols), full.report.select(*cols))
        fcols = ["result_id", "position_order", "points"]
        assert _same(read(spark, "gold_fct_race_result").select(*fcols),
                     full.fct_race_result.select(*fcols))
    finally:
        spark.conf.unset("lakestar.warehouse")


def test_dimension_change_reaches_every_report_row(spark):
    from lakestar.plans.star import driver_fields, raw_with_history
    spark.conf.set("lakestar.warehouse", scratch_path(spark, "wh-dim"))
    try:
        p = StarPipeline(spark, SF)
        p.publish(num_buckets=4)
        cust = spark.read.parquet(f"{SF}/customer.parquet")
        changed = cust.sample(fraction=0.1, seed=5).withColumn("c_name", F.concat("c_name", F.lit("_renamed")))
        p.refresh_dimension("driver", changed)
        updated = cust.join(changed.select("c_custkey"), "c_custkey", "left_anti").unionByName(changed)
        full = StarPipeline(spark, SF)
        full.__dict__["raw_driver"] = raw_with_history(updated, "c_custkey", driver_fields(),
                                                       ["driverref", "number", "forename", "surname"])
        cols = ["result_key", "race_type", "driver_fullname", "constructor_name", "points"]
        assert read(spark, "gold_report_result").where(F.col("driver_fullname").endswith("_renamed")).count() > 0
        assert _same(read(spark, "gold_report_result").select(*cols), full.report.select(*cols))
        dcols = ["driver_key", "driver_ref", "driver_fullname"]
        assert _same(read(spark, "gold_dim_driver").select(*dcols), full.dim_driver.select(*dcols))
    finally:
        spark.conf.unset("lakestar.warehouse")


def test_race_and_circuit_changes_reach_the_report(spark):
    from lakestar.plans.star import _circuit_fields, _race_fields, raw_with_history
    spark.conf.set("lakestar.warehouse", scratch_path(spark, "wh-race"))
    try:
        p = StarPipeline(spark, SF)
        p.publish(num_buckets=4)
        orders = spark.read.parquet(f"{SF}/orders.parquet")
        nation = spark.read.parquet(f"{SF}/nation.parquet")
        cust = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey")
        # races move ten days later and change driver; two circuits are renamed
        o_changed = orders.sample(fraction=0.1, seed=9) \
            .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("interval 10 days")) \
            .join(cust.withColumnRenamed("c_custkey", "new_cust"), F.col("new_cust") == (F.col("o_custkey") % 150) + 1) \
            .withColumn("o_custkey", F.col("new_cust")).drop("new_cust")
        n_changed = nation.where(F.col("n_nationkey").isin(3, 7)).withColumn("n_name", F.concat("n_name", F.lit("_X")))
        p.refresh_dimension("race", o_changed)
        p.refresh_dimension("circuit", n_changed)
        o_all = orders.join(o_changed.select("o_orderkey"), "o_orderkey", "left_anti").unionByName(o_changed)
        n_all = nation.join(n_changed.select("n_nationkey"), "n_nationkey", "left_anti").unionByName(n_changed)
        full = StarPipeline(spark, SF)
        full.__dict__["raw_race"] = raw_with_history(full._race_source(o_all), "o_orderkey", _race_fields(),
                                                     ["date", "time"])
        full.__dict__["raw_circuit"] = raw_with_history(full._circuit_source(n_all), "n_nationkey",
                                                        _circuit_fields(), ["name", "country", "alt"])
        cols = ["result_key", "race_type", "race_year", "race_date", "circuit_name", "circuit_country",
                "driver_fullname", "constructor_name", "status_name", "position_order", "points"]
        got = read(spark, "gold_report_result").select(*cols)
        assert got.where(F.col("circuit_name").endswith("_X")).count() > 0
        assert _same(got, full.report.select(*cols))
    finally:
        spark.conf.unset("lakestar.warehouse")


def test_publishing_again_changes_nothing(spark):
    spark.conf.set("lakestar.warehouse", scratch_path(spark, "wh-again"))
    try:
        p = StarPipeline(spark, SF)
        first = {k: v.count() for k, v in p.publish(num_buckets=2).items()}
        report = p.report.checkpoint()
        again = {k: v.count() for k, v in p.publish(num_buckets=2).items()}
        assert again == first and _same(p.report, report)
    finally:
        spark.conf.unset("lakestar.warehouse")
