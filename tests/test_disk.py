"""What a run leaves on disk, and how often it writes and shuffles a table."""

import os

import pytest
from pyspark.sql import functions as F

from lakestar.operators import dense_keys, upsert_with_key
from lakestar.plans import acceptance
from lakestar.plans.star import StarPipeline
from lakestar.session import CLEANUP, ensure_checkpoint_dir, materialize, passing, stored_bytes
from lakestar.sources import TableStore, catalog, load_or_upsert, read, table_exists

SMALL = "/root/testdata/sf0.001"


def _scratch(spark) -> set[str]:
    folder = ensure_checkpoint_dir(spark).removeprefix("file:") + "/lakestar"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.mark.parametrize("name", ["pipeline_two_batches", "racing_refresh", "fact_late_dimension", "racing_report"])
def test_a_run_leaves_only_its_tables(spark, name):
    before = _scratch(spark)
    rows = acceptance.QUERIES[name](spark, SMALL)
    left = _scratch(spark) - before
    assert [f.rsplit("-", 1)[0] for f in left] == ["warehouse"]
    assert rows.count() > 0 and spark.conf.get(CLEANUP, "false") != "true"


def test_a_run_that_fails_leaves_no_intermediate_rows(spark):
    before = _scratch(spark)
    with pytest.raises(ZeroDivisionError), passing(spark):
        with passing(spark):
            materialize(spark.range(10))
        kept = materialize(spark.range(20))
        assert len(_scratch(spark) - before) == 1 and kept.count() == 20 and stored_bytes(kept) > 0
        1 / 0
    assert _scratch(spark) == before


def test_shuffle_files_go_when_their_query_ends(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> int:
        return sum(b.name().startswith("shuffle_") for b in map(local.getAllBlocks().apply, range(local.getAllBlocks().size())))

    with passing(spark):
        rows = materialize(spark.range(10_000).repartition(4, "id"))
        before = shuffled()
        for _ in range(3):
            rows = materialize(rows.repartition(4, F.xxhash64("id")))
        assert rows.count() == 10_000 and shuffled() <= before


def test_an_upsert_that_deletes_writes_its_rows_once(spark, warehouse, monkeypatch):
    rows = spark.range(0, 40).select("id", F.col("id").alias("v"))
    load_or_upsert(rows, "once", ["id"], num_buckets=8)
    paths, real = [], catalog._write
    monkeypatch.setattr(catalog, "_write", lambda df, path, *a, **k: paths.append(path) or real(df, path, *a, **k))
    gone = rows.where(catalog.bucket_of(["id"], 8) == 3).unionByName(spark.range(2).select("id", F.lit(9).cast("long").alias("v"))).select("id")
    out = load_or_upsert(rows.where("id = 1").withColumn("v", F.lit(7).cast("long")), "once", ["id"], delete_keys=gone)
    assert len(paths) == 1
    want = {r.id: 7 if r.id == 1 else r.id for r in rows.join(gone.where("id <> 1"), "id", "left_anti").collect()}
    assert {r.id: r.v for r in out.collect()} == want


def test_an_upsert_with_keys_joins_its_target_once(spark, warehouse):
    load_or_upsert(spark.range(100).withColumn("v", F.lit("a")), "wide", ["id"], key_col="k", num_buckets=4)
    target = read(spark, "wide")
    gone = spark.range(10).union(spark.range(500, 501))
    out = upsert_with_key(target, spark.range(95, 110).withColumn("v", F.lit("b")), ["id"], "k", delete_keys=gone)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("k#") and sum("Relation" in line and "v#" in line and "k#" in line for line in plan.splitlines()) == 1
    got = {r.id: (r.k, r.v) for r in out.collect()}
    assert got == {i: (i + 1, "b" if i >= 95 else "a") for i in range(10, 110)}


def test_tables_split_from_one_raw_table_share_its_versions(spark, warehouse):
    p = StarPipeline(spark, SMALL)
    p.publish(num_buckets=4)
    assert not table_exists(spark, "silver_race_result__versions") and not table_exists(spark, "silver_sprint_result__versions")
    parts = [read(spark, f"silver_{t}") for t in ("race_result", "sprint_result")]
    assert read(spark, "silver_result__versions").count() == sum(p.count() for p in parts) > 0
    for rows, key in zip(parts, ("race_result_key", "sprint_result_key")):
        want = dense_keys(rows.drop(key), ["result_id"], key).select(*rows.columns)
        assert want.exceptAll(rows).isEmpty()


def test_a_large_table_is_not_shuffled_for_few_buckets(spark, warehouse, monkeypatch):
    rows = spark.range(1000).withColumn("v", F.xxhash64("id"))
    monkeypatch.setattr(catalog, "FILE_BYTES", 1)
    plan = catalog._dealt(rows, ["id"], 4, expected_bytes=1000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Exchange" in catalog._dealt(rows, ["id"], 400, expected_bytes=1000)._jdf.queryExecution().executedPlan().toString()
    load_or_upsert(rows, "few", ["id"], num_buckets=4, expected_bytes=1000)
    out = load_or_upsert(rows.where("id < 10").withColumn("v", F.lit(0).cast("long")), "few", ["id"])
    store = TableStore(spark, "few")
    assert out.count() == 1000 and out.where("v = 0").count() == 10 and store.partitions(store.state()["folder"]) == set(range(4))
    assert store.rows().where(F.col("_b") != catalog.bucket_of(["id"], 4)).isEmpty()


def test_a_large_rewrite_shuffles_in_steps(spark, warehouse, monkeypatch):
    rows = spark.range(1000).withColumn("v", F.xxhash64("id"))
    load_or_upsert(rows, "steps", ["id"], num_buckets=4)
    plans, real = [], catalog._write
    monkeypatch.setattr(catalog, "STEP_BYTES", 1)
    monkeypatch.setattr(catalog, "_write", lambda df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    before = _scratch(spark)
    out = load_or_upsert(rows.where("id < 10").withColumn("v", F.lit(0).cast("long")), "steps", ["id"])
    assert len(plans) == 1 and "Join" not in plans[0] and "RebalancePartitions" in plans[0] and _scratch(spark) == before
    assert out.count() == 1000 and out.where("v = 0").count() == 10
