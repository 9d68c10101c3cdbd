"""Table registry and Parquet tables kept by Spark's partition overwrite (S1,
S2, S7-S10).

A table is a Parquet folder that Spark partitions by ``_b``, the bucket of a
row's key (one bucket, 0, if the table has none)::

    <root>/rows-<id>/_b=17/part-*.parquet       the rows
    <root>/state/00000003.json                  newest state wins

An upsert reads the partitions that its batch touches (a partition filter, so
Spark prunes the others) and writes them back with ``partitionOverwriteMode =
dynamic``: Spark replaces exactly these partitions when the job commits.  A
whole overwrite goes to a folder of its own, and the next state names it.  Rows
that must pass a gate first are staged and published from there.

The state of a table is a few values: the folder, its columns, key and buckets,
the cursor of its last sync and the next surrogate key.  Each change is a new
file, created exclusively, so of two writers one sees the other's and tries
again.  Surrogate keys are *reserved* that way before their rows are written:
two refreshes never give the same key, and one that dies leaves a gap only.

Logical names map to roots through session conf keys ``lakestar.table.<name>``
(the reference's conf-driven registry); unset names live under
:func:`lakestar.session.warehouse_root`.  A frame that was read before a table
changed must be read anew: its files may be gone.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, passing, warehouse_root

BUCKET_COL = "_b"
GRACE_S = 10                    # after which an empty state counts as abandoned
_STATE_RE = re.compile(r"^(\d{8})\.json$")


def bucket_of(keys: Sequence[str], num_buckets: int, block_rows: int | None = None):
    """Pure function of the key values: stable across runs and versions.  With
    ``block_rows`` a bucket is a block of that many consecutive values of the
    (single, integer) key, so new keys come into new buckets."""
    if block_rows:
        return F.coalesce(F.floor(F.col(keys[0]).cast("long") / F.lit(block_rows)), F.lit(0)).cast("int")
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(num_buckets)).cast("int")


def register(spark: SparkSession, name: str, root: str) -> None:
    """Bind a logical table name to a storage root (S1 registry)."""
    spark.conf.set(f"lakestar.table.{name}", root.rstrip("/"))


def _root(spark: SparkSession, name: str) -> str:
    root = spark.conf.get(f"lakestar.table.{name}", None)
    return root if root else f"{warehouse_root(spark)}/{name}"


class TableStore:
    """The state of one table and its folder, through Hadoop's FileSystem
    (works the same on local disk, HDFS or an object store)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.root = spark, name, _root(spark, name)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, *parts: str) -> list[str]:
        folder = self._path("/".join([self.root, *parts]))
        return [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []

    def _states(self) -> list[int]:
        """Numbers of the states, newest first."""
        return sorted((int(m[1]) for m in map(_STATE_RE.match, self._list("state")) if m), reverse=True)

    def state(self) -> dict:
        """The newest state; empty before the first write."""
        for number in self._states():
            path = self._path(f"{self.root}/state/{number:08d}.json")
            while True:
                stream = self._fs.open(path)
                try:
                    text = bytes(stream.readAllBytes()).decode()
                finally:
                    stream.close()
                if text:
                    return json.loads(text)
                # its writer is about to fill it, or died before it did
                if time.time() - self._fs.getFileStatus(path).getModificationTime() / 1000 > GRACE_S:
                    break
                time.sleep(0.05)
        return {}

    def update(self, change: Callable[[dict], dict]) -> dict:
        """Apply ``change`` to the newest state.  Another writer's state that
        came first is taken into account."""
        while True:
            newest = max(self._states(), default=0)
            state = change(self.state())
            try:
                stream = self._fs.create(self._path(f"{self.root}/state/{newest + 1:08d}.json"), False)
            except Py4JJavaError as e:
                if "FileAlreadyExists" in str(e.java_exception):
                    continue
                raise
            stream.write(bytearray(json.dumps(state).encode()))
            stream.close()
            return state

    def reserve(self, n: int) -> int:
        """The first of ``n`` surrogate keys that no other writer gets."""
        return self.update(lambda s: s | {"next_key": s.get("next_key", 1) + n})["next_key"] - n

    def exists(self) -> bool:
        return "folder" in self.state()

    def cursor(self) -> int | None:
        """Cursor (integer) stored with the last sync, or None."""
        return self.state().get("cursor")

    def max_key(self) -> int | None:
        """Largest surrogate key ever given, or None."""
        top = self.state().get("next_key")
        return None if top is None else top - 1

    def bucketing(self) -> tuple[int, list[str]] | None:
        """(N, key columns) of a table in key buckets."""
        state = self.state()
        return (state["buckets"], state["keys"]) if state.get("keys") else None

    def bucket(self, columns: Sequence[str] | None = None):
        """Bucket of a row, by the table's key columns or by columns of other
        names that hold their values."""
        state = self.state()
        return bucket_of(columns or state["keys"], state["buckets"], state.get("block_rows"))

    def folder(self) -> str:
        return f"{self.root}/{self.state()['folder']}"

    def rows(self) -> DataFrame:
        """All rows with their bucket; a filter on it prunes partitions."""
        state = self.state()
        schema = T.StructType.fromJson(state["schema"]).add(BUCKET_COL, T.IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.root}/{state['folder']}")

    def size(self) -> int:
        """Bytes of the rows."""
        return self._fs.getContentSummary(self._path(self.folder())).getLength()

    def files(self, folder: str, bucket: int) -> dict[str, int]:
        """Names and bytes of a bucket's files."""
        path = self._path(f"{self.root}/{folder}/{BUCKET_COL}={bucket}")
        return {s.getPath().getName(): s.getLen() for s in self._fs.listStatus(path)} if self._fs.exists(path) else {}

    def partitions(self, folder: str) -> set[int]:
        return {int(n.split("=")[1]) for n in self._list(folder) if n.startswith(BUCKET_COL + "=")}

    def drop(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{folder}"), True)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Explicit existence test (D3): no exception-driven control flow."""
    return TableStore(spark, name).exists()


def read(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a registered table and expose it as a temp view of the same name
    (S1/S2)."""
    store = TableStore(spark, name)
    if not store.exists():
        raise FileNotFoundError(f"table {name!r} has no published rows")
    df = store.rows().drop(BUCKET_COL)
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    df.createOrReplaceTempView(name)
    return df


def touched_buckets(spark: SparkSession, name: str, batch: DataFrame, batch_keys: Sequence[str] | None = None) -> list[int]:
    """The buckets of a table that a batch touches, ascending: at most as many
    as there are buckets reach the driver.  A table without key buckets is one
    bucket, 0."""
    store = TableStore(spark, name)
    if store.bucketing() is None:
        return [0]
    return sorted(r.b for r in batch.select(store.bucket(batch_keys).alias("b")).distinct().collect())


def read_buckets(spark: SparkSession, name: str, buckets: Sequence[int]) -> DataFrame:
    """The rows in these buckets; Spark lists and reads no other partition."""
    return TableStore(spark, name).rows().where(F.col(BUCKET_COL).isin(list(buckets))).drop(BUCKET_COL)


def read_touched(spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str],
                 batch_keys: Sequence[str] | None = None) -> DataFrame:
    """The rows of a table in the key buckets that a batch touches (the whole
    table if it is not stored in buckets of these keys).  The touched bucket
    numbers, at most as many as there are buckets, reach the driver."""
    store = TableStore(spark, name)
    bucketing = store.bucketing()
    if bucketing is None or bucketing[1] != list(keys):
        return read(spark, name)
    return read_buckets(spark, name, touched_buckets(spark, name, batch, batch_keys or keys))


def replace_table(df: DataFrame, name: str, keys: Sequence[str], num_buckets: int | None = None,
                  block_rows: int | None = None, expected_bytes: int = 0, sort: bool = True) -> DataFrame:
    """A full rebuild: ``df`` becomes the whole table, without comparing it
    with the old one.  Blocks are of the first key.  A table without buckets is
    in key order, unless ``sort`` says that it needs no order."""
    bucket_by = list(keys[:1]) if block_rows else list(keys) if num_buckets else []
    save(df, name, mode="overwrite", sort_by=[] if bucket_by or not sort else list(keys), bucket_by=bucket_by,
         num_buckets=num_buckets, block_rows=block_rows, expected_bytes=expected_bytes)
    return read(df.sparkSession, name)


def sql_with_registry(spark: SparkSession, text: str, **args) -> DataFrame:
    """``spark.sql`` over registered names; each ``${name}`` in the text
    is resolved through the registry to the table."""
    for name in set(re.findall(r"\$\{([A-Za-z0-9_]+)\}", text)):
        read(spark, name)
        text = text.replace("${" + name + "}", name)
    return spark.sql(text, args or None)


def _conform(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Enforce a declared schema with one explicit cast-and-select."""
    if schema is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _dealt(df: DataFrame, keys: Sequence[str], n: int, block_rows: int | None = None, expected_bytes: int = 0,
           in_order: bool = False) -> DataFrame:
    """Rows with their bucket, brought together and sorted.  The rows of a bucket
    go to one task, small buckets several to a task; Spark deals a bucket that
    is larger than its advisory partition size to several tasks (and files), so
    no task grows with the table.  Where the table is so large that each task
    fills a file of every bucket anyway, or whose blocks lie in its tasks already
    (``in_order``), this shuffle of all rows is saved."""
    rows = df.withColumn(BUCKET_COL, bucket_of(keys, n, block_rows))
    if not (in_order if block_rows else _fills_files(df.sparkSession, expected_bytes, n)):
        rows = rows.hint("rebalance", BUCKET_COL)
    return rows.sortWithinPartitions(BUCKET_COL, *keys)


FILE_BYTES = 1 << 20            # of a file worth a file of its own
STEP_BYTES = 16 << 20           # of stored rows, from which on a rewrite shuffles in steps


def _fills_files(spark: SparkSession, expected_bytes: int, n: int) -> bool:
    """Whether tasks as Spark cuts them each hold enough for a file of every bucket."""
    tasks = max(spark.sparkContext.defaultParallelism, 4 * expected_bytes >> 26)        # rows shuffle at about 4 times their size
    return expected_bytes >= FILE_BYTES * n * tasks


def _write(df: DataFrame, path: str, expectations: Sequence = (), mode: str = "append", **options) -> None:
    """Write rows with their bucket.  Row-level expectations are observed on
    the way; if one fails, the error names it."""
    from ..operators.quality import ExpectationError, observed_metrics

    observation = None
    if expectations:
        observation = Observation(f"lakestar_{uuid.uuid4().hex[:8]}")
        metrics, finish = observed_metrics(expectations)
        df = df.observe(observation, *metrics)
    df.write.mode(mode).options(compression="zstd", **options).partitionBy(BUCKET_COL).parquet(path)
    if observation is not None:
        failed = [r for r in finish(observation.get) if not r["success"]]
        if failed:
            raise ExpectationError(failed)


def save(df: DataFrame, name: str, mode: str = "overwrite", schema: T.StructType | None = None,
         sort_by: Sequence[str] = (), expectations: Sequence = (), bucket_by: Sequence[str] = (),
         num_buckets: int | None = None, cursor: int | None = None, block_rows: int | None = None,
         expected_bytes: int = 0, in_order: bool = False) -> str:
    """Write ``df`` as table ``name``.

    ``mode='overwrite'`` writes a new folder and makes it the table's;
    ``'append'`` adds files (on the first load both create the table).
    ``sort_by`` range-partitions and sorts inside partitions (file locality
    without a single-task sort).  ``bucket_by``/``num_buckets`` store the table
    in hash buckets of its key (one shuffle, files of one bucket each, sorted by
    key); with ``block_rows`` these are blocks of consecutive integer keys,
    as many as the keys need; a table whose ``expected_bytes`` are many for its
    buckets, or whose rows come in ranges of the key (``in_order``), is not
    shuffled for them.  Row-level ``expectations`` (not-null, between, length) are
    observed during the write; if one fails nothing is published and
    :class:`~lakestar.operators.quality.ExpectationError` is raised."""
    spark = df.sparkSession
    store = TableStore(spark, name)
    add = mode == "append" and store.exists()
    if add and store.bucketing() is not None:
        raise ValueError(f"{name} is stored in key buckets: use load_or_upsert, not append")
    out = _conform(df, schema)
    columns = out.schema
    if add:
        out = out.select(*[F.col(c) for c in T.StructType.fromJson(store.state()["schema"]).names])
    n = int(num_buckets or spark.conf.get("spark.sql.shuffle.partitions")) if bucket_by else 1
    if bucket_by:
        out = _dealt(out, bucket_by, n, block_rows, expected_bytes, in_order)
    else:
        if sort_by:
            out = out.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        out = out.withColumn(BUCKET_COL, F.lit(0))
    folder = store.state()["folder"] if add and not expectations else f"rows-{uuid.uuid4().hex[:12]}"
    _write(out, f"{store.root}/{folder}", expectations)
    if add:
        if expectations:            # staged: passed, so append it
            live = store.state()["folder"]
            spark.read.schema(out.schema).parquet(f"{store.root}/{folder}").write.mode("append") \
                .option("compression", "zstd").partitionBy(BUCKET_COL).parquet(f"{store.root}/{live}")
            store.drop(folder)
        if cursor is not None:
            store.update(lambda s: s | {"cursor": int(cursor)})
        return store.folder()
    kept = {} if cursor is None else {"cursor": int(cursor)}
    store.update(lambda s: s | kept | {"folder": folder, "previous": s.get("folder"), "buckets": n, "keys": list(bucket_by),
                                       "block_rows": block_rows, "schema": T.StructType([f for f in columns]).jsonValue()})
    return store.folder()


def compact(spark: SparkSession, name: str) -> str:
    """Write the table anew with the same buckets and cursor: many small
    appended files become few."""
    store = TableStore(spark, name)
    n, keys = store.bucketing() or (None, [])
    return save(read(spark, name), name, mode="overwrite", bucket_by=keys, num_buckets=n,
                block_rows=store.state().get("block_rows"))


def vacuum(spark: SparkSession, name: str) -> list[str]:
    """Delete the folders that are neither the table's nor the one before it:
    older ones, and what failed writers left.  Returns their names."""
    store = TableStore(spark, name)
    state = store.state()
    old = [f for f in store._list() if f.startswith(("rows-", "staged-")) and f not in (state.get("folder"), state.get("previous"))]
    for folder in old:
        store.drop(folder)
    return old


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty table with a declared schema unless it exists."""
    if not table_exists(spark, name):
        save(spark.createDataFrame([], schema), name, mode="overwrite")


def replace_buckets(df: DataFrame, name: str, touched: Sequence[int], cursor: int | None = None,
                    expectations: Sequence = (), may_empty: bool = False) -> DataFrame:
    """``df`` becomes the whole content of the touched buckets; it may be
    computed from them.  Spark's dynamic partition overwrite replaces them when
    the job commits.  Rows are staged first if there are ``expectations``.  If a
    bucket may lose all its rows (``may_empty``), Spark writes none of it and
    leaves its partition alone: one that still holds its old files is dropped."""
    spark = df.sparkSession
    store = TableStore(spark, name)
    state = store.state()
    folder = state["folder"]
    before = {b: store.files(folder, b) for b in touched}
    out = df.select(*T.StructType.fromJson(state["schema"]).names)
    size, n, blocks = sum(sum(f.values()) for f in before.values()), state["buckets"], state.get("block_rows")
    with passing(spark):
        if state["keys"]:
            if size >= STEP_BYTES and (blocks or not _fills_files(spark, size, n)):
                # the disk does not hold the shuffles of the merge and of the buckets at once
                out = materialize(out, "merged")
            out = _dealt(out, state["keys"], n, blocks, size)
        else:
            out = out.withColumn(BUCKET_COL, F.lit(0))
        if expectations:
            staged = f"staged-{uuid.uuid4().hex[:12]}"
            _write(out, f"{store.root}/{staged}", expectations)
            out = spark.read.schema(out.schema).parquet(f"{store.root}/{staged}")
            if state["keys"]:
                out = _dealt(out, state["keys"], n, blocks)
        _write(out, f"{store.root}/{folder}", mode="overwrite", partitionOverwriteMode="dynamic")
    if expectations:
        store.drop(staged)
    if expectations or may_empty:
        for b in touched:
            if before[b] and before[b].keys() <= store.files(folder, b).keys():
                store.drop(f"{folder}/{BUCKET_COL}={b}")
    if cursor is not None:
        store.update(lambda s: s | {"cursor": int(cursor)})
    return read(spark, name)


def load_or_upsert(df: DataFrame, name: str, keys: Sequence[str],
                   key_col: str | None = None, schema: T.StructType | None = None,
                   update_cols: Sequence[str] | None = None,
                   insert_cols: Sequence[str] | None = None,
                   expectations: Sequence = (), num_buckets: int | None = None,
                   cursor: int | None = None, delete_keys: DataFrame | None = None,
                   validate: bool = True, block_rows: int | None = None, expected_bytes: int = 0,
                   in_order: bool = False) -> DataFrame:
    """Create the table on first load (with dense surrogate keys when
    ``key_col`` is given), otherwise upsert into it.  With ``num_buckets`` the
    table is stored in key buckets, and an upsert reads and rewrites only the
    buckets the batch touches; ``block_rows`` makes these blocks of the first
    key.  New surrogate keys are reserved before anything
    is written.  Returns the published table."""
    from ..operators.keys import dense_keys
    from ..operators.upsert import upsert, upsert_with_key

    spark = df.sparkSession
    store = TableStore(spark, name)
    if not store.exists():
        out, sort_by = df, list(keys)
        if key_col:
            # the key window already clusters rows by key range and sorts
            # them inside each partition: no second range shuffle needed
            out = dense_keys(df, list(keys), key_col, start=store.reserve)
            out = out.select(key_col, *[c for c in out.columns if c != key_col])
            sort_by = []
        save(out, name, mode="overwrite", schema=schema, sort_by=sort_by, expectations=expectations,
             bucket_by=list(keys[:1]) if block_rows else list(keys) if num_buckets else [], num_buckets=num_buckets,
             cursor=cursor, block_rows=block_rows, expected_bytes=expected_bytes, in_order=in_order)
        return read(spark, name)

    bucketing = store.bucketing()
    if bucketing is None:
        touched, target = [0], read(spark, name)
    else:
        gone = df.select(*keys) if delete_keys is None else df.select(*keys).unionByName(delete_keys.select(*keys))
        touched = touched_buckets(spark, name, gone)
        target = read_buckets(spark, name, touched)
    if key_col:
        merged = upsert_with_key(target, df, keys, key_col, delete_keys=delete_keys, validate=validate, start=store.reserve)
    else:
        merged = upsert(target, df, keys, update_cols=update_cols, insert_cols=insert_cols,
                        delete_keys=delete_keys, validate=validate)
    merged = _conform(merged, schema)
    if bucketing is None:           # the whole table is written anew, in key order
        save(merged, name, mode="overwrite", sort_by=list(keys), expectations=expectations, cursor=cursor)
        return read(spark, name)
    return replace_buckets(merged, name, touched, cursor, expectations, may_empty=delete_keys is not None)
