import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from lakestar.session import BASE_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").appName("lakestar-tests") \
        .config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests have no cluster-provided checkpoint dir: set our own
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakestar-test-ckpt-"))
    yield s


@pytest.fixture()
def warehouse(spark):
    root = tempfile.mkdtemp(prefix="lakestar-test-wh-")
    spark.conf.set("lakestar.warehouse", root)
    yield root
    spark.conf.unset("lakestar.warehouse")
