"""Session helpers: a tuned local session for tests/bench and the shared
scratch folder (``spark.checkpoint.dir``) that every job writes to."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours relies on.  AQE re-plans joins at run time
# (broadcast only when the measured side is small, skew-join splitting,
# partition coalescing); UTC keeps timestamp_ntz <-> timestamp casts exact.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # jobs submitted from several driver threads share the cores fairly
    "spark.scheduler.mode": "FAIR",
    # remove checkpoint files once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def package_on_workers(spark: SparkSession | None = None) -> None:
    """Python workers find this package wherever the driver was started from:
    before a session, through the environment that its workers inherit; in a
    session made elsewhere, through the environment its tasks are given.  A
    cluster without a shared file system gets the package with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = os.environ if spark is None else spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "lakestar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    package_on_workers()
    spark = builder.getOrCreate()
    package_on_workers(spark)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  When it is unset, a local master (tests, one
    machine) gets a folder of its own; on a cluster that is an error, since
    checkpoints, intermediates and tables would land on single machines."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    master = sc.master or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="lakestar-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def prepare(spark: SparkSession) -> None:
    """Settings that the library relies on, for a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", BASE_CONF["spark.sql.session.timeZone"])
    ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local on
    a cluster: the checkpoint dir is the cluster's shared store)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/lakestar/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, purpose: str = "rows") -> DataFrame:
    """An eager cut of the lineage, like a checkpoint: the rows are written to
    the shared scratch folder and read from there.  As Parquet they are
    compressed, later passes read only the columns they use, and the planner
    knows their size, so it joins small results without a shuffle."""
    path = scratch_path(df.sparkSession, purpose)
    folders = _folders.get()
    if folders is not None:
        folders.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Spark then removes the shuffle files of a query when it ends, not when the
# driver's garbage collector happens to meet its plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_folders: ContextVar[list[str] | None] = ContextVar("folders", default=None)
_lock = threading.Lock()
_open: dict[int, list] = {}     # per session: how many scopes are open, and the setting before the first


@contextlib.contextmanager
def passing(spark: SparkSession):
    """A run whose intermediate rows serve only itself: what :func:`materialize`
    writes in it is deleted at its end, and shuffle files at the end of each
    query, so the disk holds the published tables and one step's work.  A frame
    that outlives the run must not read its intermediate rows."""
    with _lock:
        held = _open.setdefault(id(spark), [0, None])
        if not held[0]:
            held[1] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        held[0] += 1
    folders: list[str] = []
    token = _folders.set(folders)
    try:
        yield
    finally:
        _folders.reset(token)
        jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.unset(CLEANUP) if held[1] is None else spark.conf.set(CLEANUP, held[1])


def stored_bytes(df: DataFrame) -> int:
    """Size of the folders whose files a frame reads (its tables, whole)."""
    spark = df.sparkSession
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        total += path.getFileSystem(hadoop).getContentSummary(path).getLength()
    return total


def warehouse_root(spark: SparkSession) -> str:
    """Root folder of published tables: ``lakestar.warehouse`` if set, else a
    folder inside the shared checkpoint dir."""
    root = spark.conf.get("lakestar.warehouse", None)
    if root:
        return root.rstrip("/")
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/lakestar-warehouse"
    spark.conf.set("lakestar.warehouse", root)
    return root
