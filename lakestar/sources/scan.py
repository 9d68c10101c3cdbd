"""Source scans with a parallelism floor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


COMPRESSION = 10                # rows in memory are that much larger than in a Parquet file
SPLIT_BYTES = 16 << 20          # of a file in one task: its sorts and windows hold the decoded rows


def scan(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """``spark.read.parquet`` whose partition count is at least the
    cluster's default parallelism.  A file with a single row group is one
    input split; for such small inputs a round-robin repartition spreads the
    CPU-heavy steps (JSON, windows) over all cores.  Large inputs already
    have more splits than cores and are left untouched (no extra shuffle).
    Filters and column pruning still reach the Parquet scan below the
    repartition.  A task takes at most :data:`SPLIT_BYTES` of a file, so what it
    sorts does not grow with the table; and a table counts as small enough to be
    broadcast by the size of its rows, not of its compressed file
    (:data:`COMPRESSION`)."""
    spark.conf.set("spark.sql.sources.fileCompressionFactor", COMPRESSION)
    spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    df = spark.read.parquet(path)
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        df = df.repartition(want)
    return df
