"""What the planner knows of sizes, and how large single tasks get."""

import os

from pyspark.sql import functions as F

from lakestar.operators import dense_keys
from lakestar.plans import acceptance, entities, racing
from lakestar.plans.star import StarPipeline
from lakestar.sources import TableStore, load_or_upsert, scan

SMALL = "/root/testdata/sf0.001"


def _bytes(df) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def test_numbered_rows_keep_their_size(spark):
    rows = dense_keys(spark.range(1000).withColumn("name", F.lit("x")), ["id"], "k")
    assert _bytes(rows) < 1 << 20 and rows.agg(F.min("k"), F.max("k")).first()[:] == (1, 1000)
    assert rows.where("k <> id + 1").isEmpty() and dense_keys(spark.range(0), ["id"], "k").isEmpty()


def test_known_statuses_do_not_deal_results_by_status(spark):
    p = StarPipeline(spark, SMALL)
    assert _bytes(p.silver_status) < 1 << 20
    rows, _ = p._status_rule()[0].joined(p.raw_result.withColumn("statusname", F.lit("RF")), "known")
    assert "SortMergeJoin" not in rows._jdf.queryExecution().sparkPlan().toString()


def test_both_result_tables_share_one_gate(spark, monkeypatch):
    calls, real = [], entities.gated_newest
    monkeypatch.setattr(entities, "gated_newest", lambda raw, spec, *a: calls.append(spec.name) or real(raw, spec, *a))
    p = StarPipeline(spark, SMALL)
    assert p.silver_race_result.count() > 0 and p.silver_sprint_result.count() > 0
    assert sum(name.endswith("_result") for name in calls) == 1


def test_a_well_compressed_file_is_not_taken_for_a_small_table(spark, warehouse):
    spark.range(400_000).selectExpr("id", "'the same' name").coalesce(1).write.parquet(f"{warehouse}/t.parquet")
    held = sum(os.path.getsize(f"{warehouse}/t.parquet/{f}") for f in os.listdir(f"{warehouse}/t.parquet") if f.endswith(".parquet"))
    assert held < 10 << 20 < _bytes(scan(spark, f"{warehouse}/t.parquet", 1))


def test_a_large_bucket_is_written_by_several_tasks(spark, warehouse):
    rows = spark.range(200_000).withColumn("v", F.xxhash64("id"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        out = load_or_upsert(rows, "few_buckets", ["id"], num_buckets=2)
        files = out.select("id", F.input_file_name().alias("f")).groupBy("f").count().collect()
        assert len(files) > 2 and len(TableStore(spark, "few_buckets").partitions(TableStore(spark, "few_buckets").state()["folder"])) == 2
        out = load_or_upsert(rows.where("id < 10").withColumn("v", F.lit(0).cast("long")), "few_buckets", ["id"])
        assert out.count() == 200_000 and out.where("v = 0").count() == 10
    finally:
        spark.conf.set(key, before)


def test_the_racing_run_finds_the_latest_lines_once(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(racing, "run", lambda spark, bronze, *a, **k: seen.update(bronze) or {"report_result": spark.range(0)})
    try:
        acceptance.q_racing_report(spark, SMALL)
    except Exception:           # the empty report has no columns
        pass
    assert len(seen) == 7
    assert not any("Window" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen.values())
