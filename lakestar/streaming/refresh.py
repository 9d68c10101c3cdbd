"""Micro-batch refresh (C16): the schedule-driven sync + refresh re-aimed
as Structured Streaming.

Stage 1, :func:`ingest` - a file stream over the landing folder appends
every new raw file exactly once to the bronze folder (file sink +
checkpoint; ``trigger(availableNow=True)`` processes what is there and
stops, so a scheduler can run it every few minutes).  Each micro-batch
stamps its rows with ``_ingested_at`` (the batch's ``current_timestamp``).

Stage 2, :func:`refresh_latest` - a batch upsert of the rows ingested
after the target's cursor: for every touched key the newest version among
the target row and the new rows wins (late, older rows never overwrite a
newer one), untouched keys are streamed through.  Replay after a crash is
safe because the merge is idempotent.

No Python callback runs inside the stream (no ``foreachBatch``), so the
stream needs nothing but Spark's own machinery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import latest_per_key
from ..session import scratch_path
from ..sources import RAW_COL, TableStore, flatten_json, pack_json, read, read_touched, register, replace_buckets, save
from ..sources.catalog import bucket_of

INGESTED = "_ingested_at"


def ingest(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
           max_files_per_trigger: int = 1000) -> None:
    """Append the landing folder's new files to bronze, exactly once."""
    schema = T.StructType([T.StructField(RAW_COL, T.StringType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger) \
                  .parquet(landing_dir) \
                  .withColumn(INGESTED, F.current_timestamp())
    q = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir) \
              .outputMode("append").trigger(availableNow=True).start(bronze_dir)
    q.awaitTermination()


def upsert_latest(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[Column | str]) -> DataFrame:
    """Merge where the newest version per key wins, whichever side it is on.
    The batch is the build side; the target is only streamed."""
    batch_keys = batch.select(*keys).distinct()
    untouched = target.join(batch_keys, list(keys), "left_anti")
    touched = target.join(batch_keys, list(keys), "left_semi").unionByName(batch.select(*target.columns))
    return untouched.unionByName(latest_per_key(touched, keys, order))


def refresh_latest(spark: SparkSession, bronze_dir: str, schema: T.StructType, name: str,
                   keys: Sequence[str], order: Sequence[Column | str],
                   num_buckets: int | None = None) -> DataFrame:
    """Fold the bronze rows ingested since the last refresh into table
    ``name``.  With ``num_buckets`` the table is stored in key buckets and
    a refresh reads and rewrites only the buckets its new rows touch."""
    bronze = spark.read.parquet(bronze_dir)  # reads through the sink's commit log
    store = TableStore(spark, name)
    # the ingestion cursor lives with the table's newest version: no scan
    cursor = store.cursor() if store.exists() else None
    if cursor is not None:
        bronze = bronze.where(F.col(INGESTED) > F.timestamp_micros(F.lit(cursor)))
    batch = latest_per_key(flatten_json(bronze, schema, keep=[INGESTED]), keys, order).checkpoint(eager=True)
    top = batch.agg(F.max(F.unix_micros(F.col(INGESTED))).alias("c")).first()["c"]
    if top is None and cursor is not None:
        return read(spark, name)  # nothing new
    if not store.exists():
        save(batch, name, mode="overwrite", bucket_by=list(keys) if num_buckets else (),
             num_buckets=num_buckets, cursor=top)
        return read(spark, name)
    bucketing = store.bucketing()
    if bucketing is None:
        save(upsert_latest(read(spark, name), batch, keys, order), name, mode="overwrite", cursor=top)
        return read(spark, name)
    n, bkeys = bucketing
    touched = sorted(r[0] for r in batch.select(bucket_of(bkeys, n).alias("b")).distinct().collect())  # <= n
    target = read_touched(spark, name, batch, bkeys)
    return replace_buckets(upsert_latest(target, batch, keys, order), name, touched, cursor=top)


def refresh_events_in_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table lands in two waves (before / from 2024-01-15); after
    each wave the stream ingests and the refresh merges.  The result equals
    the latest event per (user, event type) over all events."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    landing = scratch_path(spark, "landing")
    bronze = scratch_path(spark, "bronze-events")
    ckpt = scratch_path(spark, "ckpt-events")
    name = "silver_events_latest"
    register(spark, name, scratch_path(spark, "table-events-latest"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    cols = {c: c for c in ["event_id", "ts", "user_id", "event_type", "value"]}
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    out = None
    for wave in (events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)):
        pack_json(wave, cols, options=fmt).write.mode("append").parquet(landing)
        ingest(spark, landing, bronze, ckpt)
        out = refresh_latest(spark, bronze, schema, name, keys, order,
                             num_buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return out.select("user_id", "event_type", "event_id", "value")
