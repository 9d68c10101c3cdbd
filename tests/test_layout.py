"""Bucketed tables and multi-column clustering."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from lakestar.plans.acceptance import QUERIES, bucketed_star
from lakestar.sources import cluster_by, read, read_bucketed, save
from lakestar.sources.layout import curve_key

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_bucketed_sides_are_joined_and_grouped_without_an_exchange(spark, warehouse):
    joined = plan(bucketed_star(spark, SF))
    assert "SortMergeJoin" in joined and "Exchange" not in joined
    assert "Exchange" not in plan(QUERIES["bucketed_star"](spark, SF))


def test_unknown_bucketed_table(spark, warehouse):
    with pytest.raises(FileNotFoundError):
        read_bucketed(spark, "never_written")


def test_curve_interleaves_bits(spark):
    rows = spark.range(64).select(F.col("id").cast("int").alias("a"), (63 - F.col("id")).cast("int").alias("b"))
    for r in rows.select("a", "b", curve_key([F.col("a"), F.col("b")], 6).alias("k")).collect():
        assert r.k == sum(((r.a >> i) & 1) << (2 * i) | ((r.b >> i) & 1) << (2 * i + 1) for i in range(6))
    with pytest.raises(ValueError):
        curve_key([F.col("a")] * 8, 8)


def test_every_filter_skips_files_and_no_row_is_lost(spark, warehouse):
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") * 7919 % 997).cast("int"))
    rows = spark.range(20_000).select("id", (F.col("id") * 31 % 1009).alias("a"), F.when(F.col("id") % 50 != 0, day).alias("d"),
                                      F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 101).alias("hot"))
    save(cluster_by(rows, ["a", "d", "hot"], 32), "clustered")
    out = read(spark, "clustered")
    assert out.exceptAll(rows).count() == 0 and out.count() == 20_000
    files = out.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("a").alias("a"), F.min("d").alias("d"),
                                                           F.min("hot").alias("hot")).collect()
    assert len(files) == 32 and max(f.n for f in files) < 4 * 20_000 / 32
    assert sum(f.a < 50 for f in files) <= 16
    assert sum(f.d is not None and f.d < dt.date(2020, 2, 15) for f in files) <= 16
    assert sum(f.hot < 5 for f in files) <= 16


def test_clustering_an_empty_table(spark, warehouse):
    empty = spark.createDataFrame([], "a long, d date")
    assert cluster_by(empty, ["a", "d"], 4).count() == 0


def test_clustered_files_are_equally_large(spark):
    columns = ["a", "b", "c", "d", "e", "f", "g"]        # 56 bits
    rows = spark.range(20_000).select("id", *[(F.col("id") * p % 1009).alias(c) for c, p in zip(columns, (7, 11, 13, 17, 19, 23, 29))],
                                      F.lit(1).alias("one"), F.lit(None).cast("date").alias("none"))
    for by, files in ((["a", "b"], 32), (columns, 32), (["one", "none"], 32), (["a"], 1)):
        part = cluster_by(rows, by, files).groupBy(F.spark_partition_id()).count().collect()
        assert len(part) == files and sum(p["count"] for p in part) == 20_000
        assert max(abs(p["count"] - 20_000 / files) for p in part) <= 12, by
