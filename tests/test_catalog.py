import pytest
from pyspark.sql import functions as F

from lakestar.operators import ExpectationError, NotNull
from lakestar.sources import (TableStore, full_refresh, incremental_extract, load_or_upsert, read,
                              save, sql_with_registry, table_exists)
from lakestar.sources.extract import sync_incremental


def test_versions_publish_and_append(spark, warehouse):
    df = spark.range(0, 10).withColumnRenamed("id", "k")
    assert not table_exists(spark, "t1")
    save(df, "t1", mode="append", sort_by=["k"])
    save(spark.range(10, 15).withColumnRenamed("id", "k"), "t1", mode="append")
    assert read(spark, "t1").count() == 15
    save(df, "t1", mode="overwrite")
    assert read(spark, "t1").count() == 10
    assert sql_with_registry(spark, "select count(*) as n from ${t1}").collect()[0]["n"] == 10


def test_failed_gate_leaves_version_unpublished(spark, warehouse):
    save(spark.createDataFrame([(1,)], "k int"), "t2")
    with pytest.raises(ExpectationError):
        save(spark.createDataFrame([(None,)], "k int"), "t2", expectations=[NotNull("k")])
    assert [r["k"] for r in read(spark, "t2").collect()] == [1]


def test_full_refresh_twice_does_not_double(spark, warehouse):
    df = spark.range(0, 5)
    full_refresh(df, "t3")
    assert full_refresh(df, "t3").count() == 5


def test_load_or_upsert_creates_then_upserts(spark, warehouse):
    a = spark.createDataFrame([(2, "b"), (4, "d")], "id int, name string")
    b = spark.createDataFrame([(1, "a"), (4, "d2")], "id int, name string")
    load_or_upsert(a, "t4", ["id"], key_col="key")
    out = {r["id"]: (r["key"], r["name"]) for r in load_or_upsert(b, "t4", ["id"], key_col="key").collect()}
    assert out == {2: (1, "b"), 4: (2, "d2"), 1: (3, "a")}


def test_incremental_extract_and_sync(spark, warehouse):
    src = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, ts int")
    batch, cur = incremental_extract(src, "ts", 15)
    assert sorted(r["id"] for r in batch.collect()) == [2, 3] and cur == 30
    _, cur2 = incremental_extract(src, "ts", 30)
    assert cur2 == 30
    sync_incremental(spark, src.where("ts <= 20"), "raw_t", "ts")
    sync_incremental(spark, src, "raw_t", "ts")
    sync_incremental(spark, src, "raw_t", "ts")  # nothing new
    assert sorted(r["id"] for r in read(spark, "raw_t").collect()) == [1, 2, 3]


def test_cursor_filter_is_pushed_to_parquet(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    batch, _ = incremental_extract(ev, "ts", "2024-01-15 00:00:00")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, warehouse):
    from lakestar.sources.catalog import TableStore
    base = spark.range(0, 400).select(F.col("id").cast("int").alias("id"), (F.col("id") * 10).alias("v"))
    load_or_upsert(base, "tb", ["id"], key_col="key", num_buckets=16)
    store = TableStore(spark, "tb")
    folder = store.state()["folder"]
    assert store.bucketing() == (16, ["id"]) and len(store.partitions(folder)) == 16

    def files():
        return {r[0] for r in spark.read.parquet(store.folder()).select("_metadata.file_path").distinct().collect()}

    before = files()
    batch = spark.createDataFrame([(5, 1), (7, 2), (1000, 3)], "id int, v long")
    out = load_or_upsert(batch, "tb", ["id"], key_col="key")
    assert store.state()["folder"] == folder
    new = {f.split("_b=")[1].split("/")[0] for f in files() - before}
    assert 1 <= len(new) <= 3 and len(before & files()) == 16 - len(new)    # only the buckets of ids 5, 7, 1000
    got = {r["id"]: (r["key"], r["v"]) for r in out.collect()}
    assert len(got) == 401 and got[5] == (6, 1) and got[7] == (8, 2) and got[1000] == (401, 3)
    assert got[6] == (7, 60)
    # same result as the unbucketed path
    load_or_upsert(base, "tu", ["id"], key_col="key")
    ref = load_or_upsert(batch, "tu", ["id"], key_col="key")
    assert out.exceptAll(ref).count() == 0 and ref.exceptAll(out).count() == 0


def test_ensure_table_and_declared_schema(spark, warehouse):
    from pyspark.sql import types as T
    from lakestar.sources import ensure_table
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])
    ensure_table(spark, "t5", schema)
    assert table_exists(spark, "t5") and read(spark, "t5").count() == 0
    ensure_table(spark, "t5", schema)  # idempotent
    # the declared schema is enforced by one cast-and-select on write
    save(spark.createDataFrame([(1, "a", 9)], "k int, name string, extra int"), "t5", schema=schema)
    df = read(spark, "t5")
    assert df.schema == schema and df.collect()[0]["k"] == 1


def test_upsert_reads_only_touched_partitions(spark, warehouse):
    from lakestar.sources import read_touched
    load_or_upsert(spark.range(0, 400).select("id", (F.col("id") * 10).alias("v")), "tp", ["id"], num_buckets=16)
    batch = spark.createDataFrame([(5, 1), (7, 2)], "id long, v long")
    touched = read_touched(spark, "tp", batch, ["id"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_b" in plan
    assert len(touched.inputFiles()) == 16      # of the relation; the scan prunes them:
    scanned = {r[0] for r in touched.select("_metadata.file_path").distinct().collect()}
    assert 1 <= len(scanned) <= 2


def test_deleted_keys_may_empty_a_bucket(spark, warehouse):
    rows = spark.range(0, 40).select("id", F.col("id").alias("v"))
    load_or_upsert(rows, "td", ["id"], num_buckets=8)
    store = TableStore(spark, "td")
    from lakestar.sources.catalog import bucket_of
    gone = rows.where(bucket_of(["id"], 8) == 3).select("id")
    left = load_or_upsert(rows.where("id < 0"), "td", ["id"], delete_keys=gone)
    assert store.partitions(store.state()["folder"]) == set(range(8)) - {3}
    assert left.count() == 40 - gone.count()
    assert load_or_upsert(rows, "td", ["id"]).count() == 40


def test_failed_gate_leaves_buckets_as_they_were(spark, warehouse):
    load_or_upsert(spark.createDataFrame([(1, 1), (2, 2)], "id int, v int"), "tg", ["id"], num_buckets=2)
    with pytest.raises(ExpectationError):
        load_or_upsert(spark.createDataFrame([(1, None)], "id int, v int"), "tg", ["id"], expectations=[NotNull("v")])
    assert sorted(map(tuple, read(spark, "tg").collect())) == [(1, 1), (2, 2)]


def test_two_writers_never_give_the_same_key(spark, warehouse):
    from lakestar.operators import upsert_with_key
    load_or_upsert(spark.range(0, 10).select("id"), "tw", ["id"], key_col="key", num_buckets=4)
    store, target = TableStore(spark, "tw"), read(spark, "tw")
    # both read the same table and number their rows before either writes
    one = upsert_with_key(target, spark.range(100, 103).select("id"), ["id"], "key", start=store.reserve)
    two = upsert_with_key(target, spark.range(200, 205).select("id"), ["id"], "key", start=store.reserve)
    new = [r["key"] for df in (two, one) for r in df.where("id >= 100").collect()]
    assert sorted(new) == list(range(11, 19))
    # a writer that died after its reservation leaves a gap only
    out = load_or_upsert(spark.range(300, 301).select("id"), "tw", ["id"], key_col="key")
    assert {r["id"]: r["key"] for r in out.collect()}[300] == 19


def test_a_state_that_was_never_written_is_passed_over(spark, warehouse, monkeypatch):
    monkeypatch.setattr("lakestar.sources.catalog.GRACE_S", 0.2)
    save(spark.range(3), "ts")
    store = TableStore(spark, "ts")
    store._fs.create(store._path(f"{store.root}/state/{max(store._states()) + 1:08d}.json"), False).close()
    assert read(spark, "ts").count() == 3
    assert store.reserve(2) == 1 and store.reserve(1) == 3 and read(spark, "ts").count() == 3


def test_compact_and_vacuum(spark, warehouse):
    from lakestar.sources import compact, vacuum
    save(spark.range(0, 10), "tc", mode="append", cursor=7)
    for i in range(3):
        save(spark.range(100 + i, 101 + i), "tc", mode="append")
    first = TableStore(spark, "tc").state()["folder"]
    compact(spark, "tc")
    compact(spark, "tc")
    assert vacuum(spark, "tc") == [first]
    assert read(spark, "tc").count() == 13 and TableStore(spark, "tc").cursor() == 7


def test_max_key_is_tracked_without_scanning(spark, warehouse):
    from lakestar.sources.catalog import TableStore
    base = spark.range(0, 50).select(F.col("id").cast("int").alias("id"))
    load_or_upsert(base, "tk", ["id"], key_col="key", num_buckets=4)
    store = TableStore(spark, "tk")
    assert store.max_key() == 50
    out = load_or_upsert(spark.createDataFrame([(7,), (500,), (600,)], "id int"), "tk", ["id"], key_col="key")
    assert store.max_key() == 52
    got = {r["id"]: r["key"] for r in out.collect()}
    assert got[500] == 51 and got[600] == 52 and got[7] == 8
    # a batch touching only old keys keeps the maximum
    load_or_upsert(spark.createDataFrame([(3,)], "id int"), "tk", ["id"], key_col="key")
    assert store.max_key() == 52


def test_sync_keeps_its_cursor_as_state(spark, warehouse):
    import datetime as dt
    from lakestar.sources.catalog import TableStore
    from lakestar.sources.extract import sync_incremental
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 0, 5)), (2, dt.datetime(2024, 1, 2))],
                                "id int, ts timestamp_ntz")
    sync_incremental(spark, src.where("id = 1"), "raw_ts", "ts")
    assert TableStore(spark, "raw_ts").cursor() is not None
    sync_incremental(spark, src, "raw_ts", "ts")
    sync_incremental(spark, src, "raw_ts", "ts")  # nothing new
    assert sorted(r["id"] for r in read(spark, "raw_ts").collect()) == [1, 2]


def test_late_commits_and_rows_that_arrive_meanwhile_come_once(spark, warehouse, tmp_path):
    path = str(tmp_path / "src")

    def commit(rows):
        spark.createDataFrame(rows, "id int, ts int").write.mode("append").parquet(path)

    def source():
        return spark.read.parquet(path)

    commit([(1, 10), (2, 20), (2, 20), (9, None)])
    sync_incremental(spark, source(), "raw_l", "ts", lag=15)
    commit([(3, 12), (4, 20), (5, 30)])                     # below, at and above the cursor
    sync_incremental(spark, source(), "raw_l", "ts", lag=15)
    batch, top = incremental_extract(source(), "ts", 30)
    assert batch.count() == 0 and top == 30
    commit([(6, 40)])
    batch, top = incremental_extract(source(), "ts", 30)
    commit([(7, 50)])                                       # after the cursor was taken
    assert top == 40 and [r.id for r in incremental_extract(source().where("ts <= 40"), "ts", 30)[0].collect()] == [6]
    assert "ts#" in batch._jdf.queryExecution().executedPlan().toString() and "LessThanOrEqual(ts,40)" in \
        batch._jdf.queryExecution().executedPlan().toString()
    # the rows were appended, but the sync died before it stored its cursor
    save(source().where("ts = 40"), "raw_l", mode="append")
    sync_incremental(spark, source(), "raw_l", "ts", lag=15)
    sync_incremental(spark, source(), "raw_l", "ts", lag=15)
    assert sorted(((r.id, r.ts) for r in read(spark, "raw_l").collect()), key=str) == sorted(
        [(1, 10), (2, 20), (2, 20), (9, None), (3, 12), (4, 20), (5, 30), (6, 40), (7, 50)], key=str)
