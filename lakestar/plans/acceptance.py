"""The acceptance queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each on the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import NULL_SENTINEL, assemble_datetime, rename, sentinel_to_null, try_cast_columns
from ..operators import (DistinctEquals, ExpectationError, InSetOf, LengthBetween, NotNull, Unique, ValueBetween,
                         champions, count_distinct_by, dense_keys, evaluate, hash_key,
                         incident_counts, latest_per_key, lookup_keys, season_totals, standings, top_k,
                         upsert, upsert_with_key)
from ..session import materialize, passing, scratch_path
from ..sources import (RAW_COL, TableStore, cluster_by, ensure_table, flatten_json, full_refresh, incremental_extract, load_checked, load_or_upsert, pack_json, read, read_bucketed,
                       register, save, save_bucketed, scan, sql_with_registry, touched_buckets)
from ..sources.extract import sync_incremental
from . import racing
from .entities import silver_frame, silver_job
from .star import DRIVER, RACE_TIME, StarPipeline, dirty, driver_fields, raw_with_history

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fresh_table(spark: SparkSession, name: str) -> str:
    """Bind ``name`` to a new folder in the shared scratch space."""
    register(spark, name, scratch_path(spark, f"table-{name}"))
    return name


# ---- sources and sinks ------------------------------------------------------

def q_bronze_flatten(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    raw = pack_json(orders, {c: c for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]})
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    return flatten_json(raw, schema).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def q_incremental_batch(spark, sf_dir):
    batch, _cursor = incremental_extract(_t(spark, sf_dir, "events"), "ts", "2024-01-15 00:00:00")
    return batch.select("event_id", "ts")


def q_full_refresh(spark, sf_dir):
    name = _fresh_table(spark, "nation_copy")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    full_refresh(nation, name)
    return full_refresh(nation, name)  # the second refresh replaces, never doubles


def q_save_roundtrip(spark, sf_dir):
    name = _fresh_table(spark, "part_copy")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    save(part, name, mode="append", sort_by=["p_partkey"])
    return read(spark, name).select("p_partkey", "p_name", "p_size")


def q_load_or_upsert(spark, sf_dir):
    name = _fresh_table(spark, "supplier_copy")
    sup = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    load_or_upsert(sup.where(F.col("s_suppkey") % 2 == 0), name, ["s_suppkey"])
    return load_or_upsert(sup.where(F.col("s_suppkey") % 2 == 1), name, ["s_suppkey"])


# ---- projections, windows, scalar functions -----------------------------------

def q_rename_project(spark, sf_dir):
    c = rename(_t(spark, sf_dir, "customer"),
               {"c_custkey": "driver_id", "c_name": "driver_ref", "c_mktsegment": "driver_team"})
    return c.select("driver_id", "driver_ref", "driver_team")


def q_dedup_latest(spark, sf_dir):
    li = latest_per_key(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                        ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"])
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def q_dedup_latest_events(spark, sf_dir):
    ev = latest_per_key(_t(spark, sf_dir, "events"), ["user_id"], ["ts"], ["event_id"])
    return ev.select("event_id", "user_id", "ts", "event_type")


def q_sentinel_cast(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    dirty_df = c.select("c_custkey", dirty(F.col("c_nationkey"), F.col("c_custkey")).alias("number"))
    return try_cast_columns(sentinel_to_null(dirty_df, ["number"]), {"number": "int"})


def q_datetime_assemble(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    parts = ev.select(
        "event_id",
        F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.to_date("ts").cast("string")).alias("d"),
        F.when(F.col("event_type") == "error", F.lit(NULL_SENTINEL)).otherwise(F.lit(RACE_TIME)).alias("t"))
    parts = sentinel_to_null(parts, ["t"])
    return parts.select("event_id", assemble_datetime("d", "t").alias("dt"))


# ---- quality ------------------------------------------------------------------

def q_expect_not_null(spark, sf_dir):
    r = evaluate(_t(spark, sf_dir, "customer"), [NotNull("c_custkey")])
    return r.select(F.col("column").alias("col"), "n_rows", "n_bad")


def q_expect_length_between(spark, sf_dir):
    return evaluate(_t(spark, sf_dir, "part"), [LengthBetween("p_name", 1, 10)]).select("n_rows", "n_bad")


def q_expect_value_between(spark, sf_dir):
    return evaluate(_t(spark, sf_dir, "customer"), [ValueBetween("c_acctbal", 0, 9000)]).select("n_rows", "n_bad")


def q_expect_distinct_equal_set(spark, sf_dir):
    years = _t(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("bigint").alias("y"))
    r = evaluate(years, [DistinctEquals("y", range(1996, 2003))])
    return r.select(F.col("n_bad").alias("n_mismatch"))


def q_expect_fk_in_set(spark, sf_dir):
    # customers without an order
    r = evaluate(_t(spark, sf_dir, "customer"), [InSetOf("c_custkey", _t(spark, sf_dir, "orders"), "o_custkey")])
    return r.select("n_rows", "n_bad")


def q_expect_unique(spark, sf_dir):
    r = evaluate(_t(spark, sf_dir, "lineitem"), [Unique("l_orderkey", "l_linenumber")])
    return r.select(F.col("n_bad").alias("n_dup_keys"))


def q_quality_report(spark, sf_dir):
    r = evaluate(_t(spark, sf_dir, "customer"), [NotNull("c_custkey"), ValueBetween("c_acctbal", 0, 9000)])
    return r.select("rule_name", "n_bad")


# ---- keys and upsert -------------------------------------------------------------

def q_surrogate_key(spark, sf_dir):
    return dense_keys(_t(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "race_key")


def q_hash_key(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", hash_key("c_custkey").alias("hash_key"))


def _upsert_inputs(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    target = c.where(F.col("c_custkey") % 3 != 0).select("c_custkey", "c_name", "c_acctbal")
    # together they hold every customer: two thirds are stored, the batch
    # updates half of these and brings the missing third
    source = c.where((F.col("c_custkey") % 2 == 0) | (F.col("c_custkey") % 3 == 0)).select(
        "c_custkey", F.concat("c_name", F.lit("_v2")).alias("c_name"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return target, source


def q_upsert_full(spark, sf_dir):
    t, s = _upsert_inputs(spark, sf_dir)
    return upsert(t, s, ["c_custkey"])


def q_upsert_key_only(spark, sf_dir):
    t, s = _upsert_inputs(spark, sf_dir)
    return upsert(t, s, ["c_custkey"], update_cols=[], insert_cols=["c_custkey"])


def q_upsert_with_key(spark, sf_dir):
    t, s = _upsert_inputs(spark, sf_dir)
    tk = dense_keys(t, ["c_custkey"], "k").select("k", "c_custkey", "c_name", "c_acctbal")
    return upsert_with_key(tk, s, ["c_custkey"], "k")


def q_upsert_composite(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    cut = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    old = latest_per_key(ev.where(F.col("ts") < cut), keys, ["ts"], ["event_id"])
    new = latest_per_key(ev.where(F.col("ts") >= cut), keys, ["ts"], ["event_id"])
    cols = ["user_id", "event_type", "event_id", "value"]
    return upsert(old.select(*cols), new.select(*cols), keys)


# ---- silver / star / report / questions (synthetic configuration) ----------------

def _p(spark, sf_dir) -> StarPipeline:
    return StarPipeline.shared(spark, sf_dir)


def q_silver_circuit(spark, sf_dir):
    return _p(spark, sf_dir).silver_circuit.select("circuit_key", "circuit_id", "circuit_name", "circuit_alt")


def q_silver_constructor(spark, sf_dir):
    return _p(spark, sf_dir).silver_constructor.select("constructor_key", "constructor_id",
                                                       "constructor_ref", "nationality")


def q_silver_driver(spark, sf_dir):
    return _p(spark, sf_dir).silver_driver.select("driver_key", "driver_id", "driver_ref", "number")


def q_silver_race(spark, sf_dir):
    return _p(spark, sf_dir).silver_race.select("race_key", "race_id", "race_year", "race_datetime")


_RESULT_COLS = ["result_id", "race_id", "constructor_id", "status_name", "position", "points"]


def q_silver_race_result(spark, sf_dir):
    return _p(spark, sf_dir).silver_race_result.select("race_result_key", *_RESULT_COLS)


def q_silver_sprint_result(spark, sf_dir):
    return _p(spark, sf_dir).silver_sprint_result.select("sprint_result_key", *_RESULT_COLS)


def q_silver_status(spark, sf_dir):
    return _p(spark, sf_dir).silver_status.select("status_key", "status_name")


def q_star_dim_constructor(spark, sf_dir):
    return _p(spark, sf_dir).dim_constructor.select("constructor_key", "constructor_name",
                                                    "constructor_nationality")


def q_star_dim_driver(spark, sf_dir):
    return _p(spark, sf_dir).dim_driver.select("driver_key", "driver_fullname")


def q_star_dim_race(spark, sf_dir):
    return _p(spark, sf_dir).dim_race.select("race_key", "circuit_name", "circuit_country",
                                             "race_year", "race_date")


def q_star_dim_status(spark, sf_dir):
    return _p(spark, sf_dir).dim_status.select("status_key", "status_name")


def q_star_dim_circuit(spark, sf_dir):
    return _p(spark, sf_dir).dim_circuit()


def q_star_fct_race(spark, sf_dir):
    return _p(spark, sf_dir).fct_race_result


def q_star_fct_sprint(spark, sf_dir):
    return _p(spark, sf_dir).fct_sprint_result


def q_report_result(spark, sf_dir):
    return _p(spark, sf_dir).report


def _win():
    return (F.col("position_order") == 1) & (F.col("race_type") == "full_race")


def _totals(spark, sf_dir, competitor: str):
    return season_totals(_p(spark, sf_dir).report, "race_year", competitor, "points", _win())


def q_driver_standings(spark, sf_dir):
    return standings(_totals(spark, sf_dir, "driver_fullname")) \
        .select("race_year", "competitor", "total_points", "wins", "season_rank")


def q_constructor_standings(spark, sf_dir):
    return standings(_totals(spark, sf_dir, "constructor_name")) \
        .select("race_year", "competitor", "total_points", "wins", "season_rank")


def q_champion_driver(spark, sf_dir):
    return champions(_totals(spark, sf_dir, "driver_fullname"))


def q_champion_constructor(spark, sf_dir):
    return champions(_totals(spark, sf_dir, "constructor_name"))


def _races_per_country(spark, sf_dir):
    return count_distinct_by(_p(spark, sf_dir).dim_race, "circuit_country", "race_key", "races")


def q_races_per_country(spark, sf_dir):
    return _races_per_country(spark, sf_dir)


def q_top_countries(spark, sf_dir):
    return top_k(_races_per_country(spark, sf_dir), [F.col("races").desc(), F.col("circuit_country").asc()], 3)


def q_dangerous_circuits(spark, sf_dir):
    return incident_counts(_p(spark, sf_dir).report, "circuit_name", "status_name", ["RF", "RO"])


# ---- a second batch through published tables ---------------------------------------

def _own_warehouse(spark, run):
    """Run against tables of its own; the frame returned stays bound to their
    files.  Of the run's intermediate rows nothing stays."""
    before = spark.conf.get("lakestar.warehouse", None)
    spark.conf.set("lakestar.warehouse", scratch_path(spark, "warehouse"))
    try:
        with passing(spark):
            return run()
    finally:
        if before is None:
            spark.conf.unset("lakestar.warehouse")
        else:
            spark.conf.set("lakestar.warehouse", before)


def q_silver_late_version(spark, sf_dir):
    """The second batch holds older versions of even customers and newer ones
    of every third: the newest of all wins and keys stay."""
    cust = _t(spark, sf_dir, "customer")

    def raw(rows, name, updated_at, ingested):
        fields = {"driverid": "c_custkey", "driverref": name, "number": F.col("c_nationkey").cast("string"),
                  "forename": "c_mktsegment", "surname": "c_name", "updated_at": F.lit(updated_at).cast("timestamp_ntz")}
        return pack_json(rows, fields).withColumn("_ingested_at", F.lit(ingested).cast("timestamp"))

    def run():
        first = raw(cust, F.col("c_name"), "2024-01-02 00:00:00", "2024-02-01 00:00:00")
        silver_job(first, DRIVER, incremental=True, num_buckets=8)
        older = raw(cust.where(F.col("c_custkey") % 2 == 0), F.lit("stale"), "2023-01-01 00:00:00", "2024-02-02 00:00:00")
        newer = raw(cust.where(F.col("c_custkey") % 3 == 0), F.concat("c_name", F.lit("_new")), "2025-01-01 00:00:00",
                    "2024-02-02 00:00:00")
        both = first.unionByName(older).unionByName(newer)
        silver_job(both, DRIVER, incremental=True, num_buckets=8)
        # a third batch with nothing but older versions changes nothing
        again = raw(cust, F.lit("stale"), "2022-01-01 00:00:00", "2024-02-03 00:00:00")
        return silver_job(both.unionByName(again), DRIVER, incremental=True, num_buckets=8) \
            .select("driver_key", "driver_id", "driver_ref")
    return _own_warehouse(spark, run)


def _latest_lines(spark, sf_dir):
    return latest_per_key(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                          ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"])


def q_pipeline_two_batches(spark, sf_dir):
    """Publish, then results, drivers, races and results again, the last with
    versions older than those stored: the report of a full rebuild."""
    def run():
        p = StarPipeline(spark, sf_dir)
        p.publish(num_buckets=4)
        lines = materialize(_latest_lines(spark, sf_dir), "lines")      # each batch is made of them

        def changed(number, points, day):
            return lines.where(F.col("l_linenumber") == number).withColumns({
                "l_quantity": F.col("l_quantity") + points, "l_shipdate": F.lit(day).cast("timestamp_ntz")})

        p.refresh_results(changed(1, 1000, "2030-01-01"), num_buckets=4)
        p.refresh_dimension("driver", _t(spark, sf_dir, "customer").where(F.col("c_custkey") % 5 == 0)
                            .withColumn("c_name", F.concat("c_name", F.lit("_x"))), num_buckets=4)
        p.refresh_dimension("race", _t(spark, sf_dir, "orders").where(F.col("o_orderkey") % 7 == 1).withColumn(
            "o_orderdate", F.date_add(F.trunc("o_orderdate", "year"), 165).cast("timestamp_ntz")), num_buckets=4)
        # newer versions of line 2 and, in the same batch, older ones of line 1
        p.refresh_results(changed(2, 500, "2031-01-01").unionByName(changed(1, 7, "1980-01-01")), num_buckets=4)
        return p.report.select("result_key", "race_type", "race_year", "race_date", "driver_fullname",
                               "constructor_name", "status_name", "position_order", "points")
    return _own_warehouse(spark, run)


def q_fact_late_dimension(spark, sf_dir):
    """A third of the drivers arrive after their results: the facts are
    complete once they are there."""
    cust = _t(spark, sf_dir, "customer")
    late = F.col("c_custkey") % 3 == 0

    def run():
        p = StarPipeline(spark, sf_dir)
        p.frames["raw_driver"] = raw_with_history(cust.where(~late), "c_custkey", driver_fields(),
                                                  ["driverref", "number", "forename", "surname"])
        p.publish(num_buckets=8)
        p.refresh_dimension("driver", cust.where(late), num_buckets=8)
        drivers = p.dim_driver.select("driver_key", "driver_ref")
        return p.fct_race_result.join(drivers, "driver_key").select("result_id", "race_key", "driver_ref",
                                                                    "constructor_key", "points")
    return _own_warehouse(spark, run)


# ---- the racing configuration on the given tables ----------------------------------

def _racing_bronze(spark, sf_dir, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """Raw rows with the racing fields: nation = circuit, customer = driver,
    supplier = constructor, order = race, latest line = result.  A run that
    reads several of them finds the latest ``lines`` once."""
    at = F.lit("2024-01-02 00:00:00").cast("timestamp")
    nation = _t(spark, sf_dir, "nation").join(_t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust, orders = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "orders")
    lines = (_latest_lines(spark, sf_dir) if lines is None else lines).join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.col("o_orderkey")
    clock = dirty(F.lit(RACE_TIME), key)
    day = F.to_date("o_orderdate")
    sessions = {}
    for k, s in enumerate(racing.SESSIONS):
        # every other session, by race, was not held
        sessions[f"{s}_date"] = F.when((key + k) % 2 == 0, F.date_sub(day, k).cast("string")).otherwise(NULL_SENTINEL)
        sessions[f"{s}_time"] = clock
    rid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    status = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    result = {"raceid": "l_orderkey", "driverid": "o_custkey", "constructorid": "l_suppkey",
              "number": dirty(F.col("l_linenumber"), rid), "grid": "l_linenumber",
              "position": dirty(F.col("l_linenumber"), rid), "positiontext": F.col("l_linenumber").cast("string"),
              "positionorder": "l_linenumber", "points": "l_quantity", "laps": F.col("l_quantity").cast("int"),
              "time": F.lit(RACE_TIME), "milliseconds": dirty(F.col("l_partkey") * 10_000_000_000, rid),
              "fastestlap": dirty(F.col("l_linenumber"), rid), "fastestlaptime": F.lit("1:23.456"),
              "statusid": status, "updated_at": at}
    race_result = {"resultid": rid, **result, "rank": dirty(F.col("l_linenumber"), rid),
                   "fastestlapspeed": dirty(F.col("l_extendedprice"), rid)}
    return {
        "circuit": pack_json(nation, {
            "circuitid": F.col("n_nationkey") + 1, "circuitref": "n_name", "name": "n_name", "location": "r_name",
            "country": "r_name", "lat": F.col("n_nationkey") - 10.5, "lng": F.col("n_nationkey") * 7.0,
            "alt": dirty(F.col("n_regionkey"), F.col("n_nationkey")), "url": "n_name", "updated_at": at}),
        "driver": pack_json(cust, {
            "driverid": "c_custkey", "driverref": "c_name", "number": dirty(F.col("c_nationkey"), F.col("c_custkey")),
            "code": F.col("c_mktsegment").substr(1, 3), "forename": "c_mktsegment", "surname": "c_name",
            "dob": F.lit("1990-01-01"), "nationality": "c_mktsegment", "url": "c_name", "updated_at": at}),
        "constructor": pack_json(_t(spark, sf_dir, "supplier"), {
            "constructorid": "s_suppkey", "constructorref": "s_name", "name": "s_name",
            "nationality": F.col("s_nationkey").cast("string"), "url": "s_name", "updated_at": at}),
        "race": pack_json(orders.join(cust.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")), {
            "raceid": key, "year": F.year("o_orderdate"), "round": key % 20, "circuitid": F.col("c_nationkey") + 1,
            "name": "o_orderpriority", "date": day.cast("string"), "time": clock, "url": "o_orderstatus", **sessions,
            "updated_at": at}),
        "race_result": pack_json(lines.where("l_linestatus = 'F'"), race_result),
        "sprint_result": pack_json(lines.where("l_linestatus = 'O'"), {"sprintresultid": rid, **result}),
        "status": pack_json(lines.select(status.alias("statusid")).distinct(), {
            "statusid": "statusid", "status": F.concat(F.lit("status "), "statusid"), "updated_at": at}),
    }


_SEASONS = range(1995, 2002)


def q_racing_silver_race(spark, sf_dir):
    """Six session datetimes, some with a date or a time missing."""
    spec = racing.specs(_SEASONS)["race"]
    return silver_frame(_racing_bronze(spark, sf_dir)["race"], spec).select(
        "race_key", "race_id", "circuit_id", "year", "round", "datetime", "fp1_datetime", "fp2_datetime",
        "fp3_datetime", "quali_datetime", "sprint_datetime")


def q_racing_silver_result(spark, sf_dir):
    spec = racing.specs(_SEASONS)["race_result"]
    return silver_frame(_racing_bronze(spark, sf_dir)["race_result"], spec).select(
        "race_result_key", "race_result_id", "car_number", "position", "laps", "milliseconds", "fastest_lap_rank",
        "fastest_lap_speed")


def q_racing_report(spark, sf_dir):
    """The whole racing run, from raw rows to the published report."""
    return _own_warehouse(spark, lambda: racing.run(spark, _racing_bronze(spark, sf_dir, materialize(_latest_lines(spark, sf_dir), "lines")), _SEASONS)["report_result"].select(
        "result_key", "race_type", "race_name", "race_year", "race_date", "circuit_name", "circuit_country", "circuit_lat",
        "circuit_alt", "driver_ref", "driver_number", "driver_fullname", "constructor_name", "status_name",
        "position_order", "points", "laps", "milliseconds"))


def q_racing_refresh(spark, sf_dir):
    """C12-C14, a refresh in proportion to its batch: the first run lacks the
    last orders' results, every 40th customer, and has an old name of a nation;
    the second brings them.  Rows of the report, and how many of the results'
    blocks the new results alone touch."""
    return _own_warehouse(spark, lambda: _racing_refresh(spark, sf_dir))


def _racing_refresh(spark, sf_dir):
    bronze = _racing_bronze(spark, sf_dir, materialize(_latest_lines(spark, sf_dir), "lines"))
    top = _t(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    block = max(top * 10 // 64, 1)          # result ids are order and line
    payload = {"race_result": "bigint", "sprint_result": "bigint", "driver": "int", "circuit": "int"}
    ids = {e: F.get_json_object(RAW_COL, f"$.{k}").cast(payload[e]) for e, k in
           {"race_result": "resultid", "sprint_result": "sprintresultid", "driver": "driverid", "circuit": "circuitid"}.items()}
    late = {"race_result": ids["race_result"] > top * 9.9, "sprint_result": ids["sprint_result"] > top * 9.9,
            "driver": ids["driver"] % 40 == 0, "circuit": F.lit(False)}
    # raw rows are stored, as a source's are, with what the batches are told apart by
    for e in late:
        bronze[e] = materialize(bronze[e].select(RAW_COL, ids[e].alias("id"), F.coalesce(late[e], F.lit(False)).alias("late")), f"raw-{e}")
    late, ids = {e: F.col("late") for e in late}, {e: F.col("id") for e in ids}

    def stamped(df, when):
        return df.withColumn("_ingested_at", F.lit(when).cast("timestamp"))

    first = {e: stamped(df.where(~late[e]) if e in late else df, "2024-02-01 00:00:00") for e, df in bronze.items()}
    old = F.when(ids["circuit"] == 3, F.regexp_replace(F.regexp_replace(RAW_COL, '"name":"[^"]*"', '"name":"old"'),
                                                       "2024-01-02", "2023-01-02")).otherwise(F.col(RAW_COL))
    first["circuit"] = first["circuit"].withColumn(RAW_COL, old)
    second = {e: df.unionByName(stamped(bronze[e].where(late[e] if e != "circuit" else ids[e] == 3), "2024-02-02 00:00:00"))
              if e in late else df for e, df in first.items()}

    racing.run(spark, first, _SEASONS, incremental=True, num_buckets=8, block_rows=block)
    news = second["race_result"].where(late["race_result"]).select(ids["race_result"].alias("id"))
    share = len(touched_buckets(spark, "silver_race_result", news, ["id"])) / 64
    return racing.run(spark, second, _SEASONS, incremental=True)["report_result"].select(
        "result_key", "race_type", "race_name", "circuit_name", "driver_fullname", "constructor_name", "status_name",
        "points", F.lit(share < 0.1).alias("few_blocks"))


def q_incremental_ties(spark, sf_dir):
    """Two syncs whose cursor, a day, many rows share: rows of the last day
    that arrive later are not lost."""
    name = _fresh_table(spark, "events_by_day")
    days = _t(spark, sf_dir, "events").select("event_id", "ts", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    early = days.where((F.col("day") < cut) | ((F.col("day") == cut) & (F.col("event_id") % 2 == 0)))
    sync_incremental(spark, early, name, "day")
    sync_incremental(spark, days, name, "day")
    sync_incremental(spark, days, name, "day")
    return read(spark, name).select("event_id", "ts")


def q_incremental_late_commit(spark, sf_dir):
    """A second sync re-reads two weeks below its cursor: every tenth event was
    committed late, below the cursor, and arrives once, as do all others; a
    sync that died before it stored its cursor, and a third one, add nothing."""
    name = _fresh_table(spark, "events_late")
    events = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    late = F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0
    near = F.col("ts") >= cut - F.expr("interval 10 days")
    sync_incremental(spark, events.where((F.col("ts") < cut) & ~(late & near)), name, "ts")
    day = events.where((F.col("ts") >= cut) & (F.col("ts") < cut + F.expr("interval 1 day")))
    save(day, name, mode="append")              # appended, but the cursor was not stored
    for _ in range(2):
        sync_incremental(spark, events, name, "ts", lag=14 * 86_400)
    return read(spark, name)


def q_upsert_two_writers(spark, sf_dir):
    """Two refreshes read the same table, number their new suppliers, then
    write one after the other: keys are reserved, so none is given twice."""
    sup = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    name = _fresh_table(spark, "supplier_keys")
    old = F.col("s_suppkey") % 3 == 0
    load_or_upsert(sup.where(old), name, ["s_suppkey"], key_col="k", num_buckets=4)
    store, target = TableStore(spark, name), read(spark, name).checkpoint()
    batches = [sup.where(~old & (F.col("s_suppkey") % 2 == r)) for r in (0, 1)]
    numbered = [upsert_with_key(target, b, ["s_suppkey"], "k", start=store.reserve) for b in batches]
    for rows, batch in zip(numbered, batches):
        load_or_upsert(rows.join(batch.select("s_suppkey"), "s_suppkey", "left_semi"), name, ["s_suppkey"])
    return read(spark, name).agg(F.count("*").alias("n_rows"), F.count_distinct("k").alias("n_keys"),
                                 F.min("k").alias("low"), F.max("k").alias("high"),
                                 F.count_if(F.col("s_suppkey") % 3 == 0).alias("n_old"))


def q_upsert_partitions(spark, sf_dir):
    """An upsert of a few orders into 64 key buckets: the rows of all buckets
    afterwards, and how many partitions the batch wrote."""
    name = _fresh_table(spark, "orders_in_buckets")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    load_or_upsert(orders, name, ["o_orderkey"], num_buckets=64)
    before = TableStore(spark, name).rows().select("_metadata.file_path").distinct().checkpoint()
    batch = orders.where(F.col("o_orderkey") <= 8).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    out = load_or_upsert(batch, name, ["o_orderkey"])
    new = TableStore(spark, name).rows().select("_metadata.file_path").distinct().join(before, "file_path", "left_anti")
    return out.withColumn("few_written", F.lit(new.count() <= batch.count()))


def q_bronze_quarantine(spark, sf_dir):
    """Every eleventh payload is cut off, every thirteenth has a price that is
    no number, every seventeenth is missing: both tables of one parse."""
    key = F.col("o_orderkey")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    text = F.col("_raw")
    raw = pack_json(_t(spark, sf_dir, "orders"), {c: c for c in schema.names}, keep=["o_orderkey"]).withColumn(
        "_raw", F.when(key % 11 == 0, F.substring(text, 1, 14)).when(
            key % 13 == 0, F.regexp_replace(text, '"o_totalprice":[^}]*', '"o_totalprice":"n/a"'))
        .when(key % 17 != 0, text))
    typed, bad = load_checked(raw, schema, _fresh_table(spark, "orders_checked"), max_share=0.3)
    return typed.withColumns({"reason": F.lit(None).cast("string"), "n": F.lit(1).cast("long")}).unionByName(
        bad.groupBy("reason").agg(F.sum("n").alias("n")), allowMissingColumns=True)


def q_hash_key_multi(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    segment = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).when(F.col("c_custkey") % 3 == 1, F.lit("")) \
        .otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", hash_key(F.col("c_name"), segment, F.col("c_nationkey")).alias("hash_key"))


def q_cast_long_float(spark, sf_dir):
    """F3/F4 on dirty text."""
    o = _t(spark, sf_dir, "orders")
    text = o.select("o_orderkey", dirty(F.col("o_custkey"), F.col("o_orderkey")).alias("milliseconds"),
                    dirty(F.col("o_totalprice"), F.col("o_orderkey")).alias("speed"))
    return try_cast_columns(sentinel_to_null(text, ["milliseconds", "speed"]),
                            {"milliseconds": "bigint", "speed": "double"})


def q_expect_not_null_fk(spark, sf_dir):
    """E1/E2 where NULLs do occur: the sentinel of a foreign key."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", dirty(F.col("c_nationkey"), F.col("c_custkey")).alias("nation_id"))
    r = evaluate(sentinel_to_null(c, ["nation_id"]), [NotNull("c_custkey"), NotNull("nation_id")])
    return r.select(F.col("column").alias("col"), "n_rows", "n_bad")


def q_gate_stops_load(spark, sf_dir):
    """A load that breaks its rules leaves the published table as it was."""
    name = _fresh_table(spark, "gated")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    save(c, name, expectations=[NotNull("c_custkey")])
    try:
        save(c.withColumn("c_name", F.lit("wrong")), name, expectations=[ValueBetween("c_acctbal", 0, 1)])
    except ExpectationError:
        return read(spark, name).select("c_custkey", "c_name")
    raise AssertionError("the gate let a bad load pass")


def q_incident_rate(spark, sf_dir):
    return incident_counts(_p(spark, sf_dir).report, "circuit_name", "status_name", ["RF", "RO"], with_rate=True)


def q_declared_schema(spark, sf_dir):
    """An empty table with a declared schema, then a load that is cast to it."""
    name = _fresh_table(spark, "part_declared")
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_size", T.LongType()),
                           T.StructField("p_retailprice", T.DecimalType(12, 2))])
    ensure_table(spark, name, schema)
    save(_t(spark, sf_dir, "part"), name, mode="append", schema=schema)
    return read(spark, name)


def q_sorted_load(spark, sf_dir):
    """O1: rows per table and neighbours within a file that are out of order."""
    name = _fresh_table(spark, "orders_sorted")
    save(_t(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey"), name, sort_by=["o_totalprice", "o_orderkey"])
    rows = read(spark, name).select("o_totalprice", "o_orderkey", F.input_file_name().alias("f"),
                                    F.monotonically_increasing_id().alias("i"))
    last = F.lag(F.struct("o_totalprice", "o_orderkey")).over(Window.partitionBy("f").orderBy("i"))
    return rows.withColumn("last", last).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("last") > F.struct("o_totalprice", "o_orderkey")).alias("n_out_of_order"))


def bucketed_star(spark, sf_dir) -> DataFrame:
    """Lines with the keys of their order, both stored in equal buckets of the
    order's key."""
    tag = uuid.uuid4().hex[:8]          # Spark's catalog is shared by the session's queries
    fact, dim = (_fresh_table(spark, f"{n}_{tag}") for n in ("lines_in_buckets", "orders_in_buckets"))
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    save_bucketed(lines, fact, ["l_orderkey"], 16)
    save_bucketed(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), dim, ["o_orderkey"], 16)
    spark.sql(f"DROP TABLE {dim}")      # another session: defined anew from the table's folder
    return lookup_keys(read_bucketed(spark, fact), read_bucketed(spark, dim).hint("merge"), "l_orderkey", "o_orderkey",
                       "o_custkey", keep_natural=True)


def q_bucketed_star(spark, sf_dir):
    """J2 without a shuffle of either side, nor of the totals per order."""
    return bucketed_star(spark, sf_dir).groupBy("l_orderkey").agg(
        F.first("o_custkey").alias("o_custkey"), F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))


def q_clustered_load(spark, sf_dir):
    """O1 on three columns: the rows that a filter on each of them finds, and
    whether the files' ranges let it skip at least half of the files."""
    name = _fresh_table(spark, "lines_clustered")
    columns = ["l_partkey", "l_suppkey", "l_shipdate"]
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", *columns).withColumn("l_shipdate", F.to_date("l_shipdate"))
    save(cluster_by(lines, columns, 64), name)
    rows = read(spark, name)
    value = {c: F.unix_date(c).cast("long") if c == "l_shipdate" else F.col(c) for c in columns}
    low = rows.agg(*[(F.min(v) + F.floor((F.max(v) - F.min(v)) / 20)).alias(c) for c, v in value.items()]).first()
    # where each file's range begins, as its footer has it
    least = rows.groupBy(F.input_file_name().alias("f")).agg(*[F.min(v).alias(c) for c, v in value.items()])
    skipped = least.agg(*[(F.count_if(F.col(c) < low[c]) * 2 <= F.count("*")).alias(c) for c in columns]).first()
    out = [rows.where(value[c] < low[c]).agg(F.lit(c).alias("filter"), F.count("*").alias("n_rows"),
                                             F.sum("l_orderkey").alias("sum_keys"), F.lit(skipped[c]).alias("half_skipped"))
           for c in columns]
    return out[0].unionByName(out[1]).unionByName(out[2])


def q_sql_year_totals(spark, sf_dir):
    """A statement with a CTE over registered names."""
    save(_t(spark, sf_dir, "orders"), _fresh_table(spark, "all_orders"))
    return sql_with_registry(spark, """
        WITH priced AS (SELECT year(o_orderdate) AS y, o_orderstatus AS status, o_totalprice AS price FROM ${all_orders})
        SELECT y, count(*) AS n_orders, count_if(status = 'F') AS n_filled, max(price) AS top_price
        FROM priced GROUP BY y""")


def q_stream_refresh(spark, sf_dir):
    from ..streaming.refresh import refresh_events_in_waves
    return refresh_events_in_waves(spark, sf_dir)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
