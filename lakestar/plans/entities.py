"""Generic silver refinement driven by a declarative entity spec.

One spec per entity replaces a hand-written notebook: flatten the raw JSON
against the declared schema, gate on quality, keep the latest version per
natural key, turn sentinels into NULL, cast, assemble datetimes, rename,
project, and assign dense surrogate keys.  The racing configuration
(:mod:`lakestar.plans.racing`) and the synthetic star configuration
(:mod:`lakestar.plans.star`) are both just lists of these specs.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import assemble_datetimes, rename, sentinel_to_null, try_cast_columns
from ..operators import check, dense_keys, latest_per_key
from ..operators.ordered import BUCKET, POSITION, normalize_order, number_placed, range_buckets
from ..operators.quality import (DistinctEquals, Expectation, ExpectationError, InSetOf, InValues, NotNull,
                                observed_metrics)
from ..session import materialize, stored_bytes
from ..sources import RAW_COL, TableStore, flatten_json, load_or_upsert, read, read_touched, save, table_exists


@dataclass
class EntitySpec:
    name: str
    raw_schema: T.StructType
    natural_key: Sequence[str]                       # raw field names
    key_col: str | None = None                       # surrogate key column
    cursor: str = "updated_at"                       # recency order (newest wins)
    tiebreak: Sequence[str] = ()                     # further descending order columns
    sentinel_cols: Sequence[str] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    datetimes: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)
    columns: Sequence[str] | None = None             # projection after renames (key excluded)
    rules: Sequence[Expectation] = ()                # evaluated on the raw rows (before dedup)
    set_rules: Callable[[DataFrame], Sequence[Expectation]] | None = None
    after_dedup: Callable[[DataFrame], DataFrame] | None = None
    split: tuple[str, object] | None = None          # of the latest versions, those with this value of a raw field
    versions: str | None = None                      # table of versions, of all splits of one raw table

    @property
    def key_order(self) -> list[str]:
        return [self.renames.get(k, k) for k in self.natural_key]

    @property
    def placed(self) -> bool:
        """Whether the latest versions are stored in the order in which their
        surrogate keys are given: cleaning then leaves the natural key and the
        rows as they are."""
        changed = {*self.sentinel_cols, *self.casts, *self.datetimes}
        return self.key_col is not None and self.after_dedup is None and changed.isdisjoint(self.natural_key)


RAW_HASH = "_raw_hash"


def flatten(raw: DataFrame, spec: EntitySpec, payload_col: str = RAW_COL) -> DataFrame:
    """Parse the payload; keep a 64-bit hash of the raw text as the final
    tie-breaker of the latest-version order (D7: two versions with the same
    ``updated_at`` resolve the same way on every run, whatever the input
    order; equal hashes mean identical text)."""
    return flatten_json(raw.withColumn(RAW_HASH, F.xxhash64(payload_col)), spec.raw_schema,
                        payload_col, keep=[RAW_HASH])


def newest(flat: DataFrame, spec: EntitySpec) -> DataFrame:
    """Latest version per natural key."""
    tiebreak = list(spec.tiebreak) + ([RAW_HASH] if RAW_HASH in flat.columns else [])
    return latest_per_key(flat, list(spec.natural_key), [spec.cursor], tiebreak)


def clean(latest: DataFrame, spec: EntitySpec) -> DataFrame:
    """Filter, clean, type, rename and project the latest versions."""
    df = split(latest, spec)
    if spec.after_dedup is not None:
        df = spec.after_dedup(df)
    if spec.sentinel_cols:
        df = sentinel_to_null(df, spec.sentinel_cols)
    if spec.casts:
        df = try_cast_columns(df, spec.casts)
    if spec.datetimes:
        df = assemble_datetimes(df, spec.datetimes)
    if spec.renames:
        df = rename(df, spec.renames)
    if spec.columns is not None:
        df = df.select(*spec.columns)
    return df.drop(RAW_HASH, BUCKET, POSITION)


def split(latest: DataFrame, spec: EntitySpec) -> DataFrame:
    """The latest versions that are this table's."""
    return latest if spec.split is None else latest.where(F.col(spec.split[0]) == F.lit(spec.split[1]))


def numbered(latest: DataFrame, spec: EntitySpec, start: int | Callable[[int], int] = 1) -> DataFrame:
    """The refined rows with surrogate keys in natural-key order, key column
    first.  Latest versions that lie in that order are numbered where they lie."""
    if POSITION in latest.columns:
        rows = number_placed(split(latest, spec), spec.key_col, start)
        df = clean(rows, replace(spec, columns=spec.columns and [spec.key_col, *spec.columns]))
    else:
        df = dense_keys(clean(latest, spec), spec.key_order, spec.key_col, start)
    return df.select(spec.key_col, *[c for c in df.columns if c != spec.key_col])


def refine(flat: DataFrame, spec: EntitySpec) -> DataFrame:
    """Latest version per key, then clean, type, rename and project."""
    return clean(newest(flat, spec), spec)


def gated_newest(raw: DataFrame, spec: EntitySpec, run_gate: bool = True,
                 extra_rules: Sequence[Expectation] = ()) -> DataFrame:
    """Gate the raw rows and reduce them to the latest versions; the result
    is written to the shared scratch folder.

    One scan of the raw rows does all of it: reference rules join the known
    keys to the parsed rows, these and the row-level rules are *observed*,
    duplicates are reduced to the latest version, and the result is
    materialized (lineage cut: later passes do not read the raw JSON again).  Only rules on whole groups (uniqueness) run
    as jobs of their own.  The gate raises before anything is returned, so
    nothing unchecked is ever published.  Rows that will be numbered by their
    natural key are stored in its order (within a split's value)."""
    flat = flatten(raw, spec)
    columns = flat.columns
    rules = list(spec.rules) + list(spec.set_rules(flat) if spec.set_rules else []) + list(extra_rules)
    if not run_gate:
        rules = []
    for i, rule in enumerate(rules):
        if isinstance(rule, InSetOf):
            flat, rules[i] = rule.joined(flat, f"_known{i}")
    row_rules = [r for r in rules if r.row_level]
    group_rules = [r for r in rules if not r.row_level]
    observation = None
    if row_rules:
        observation = Observation(f"gate_{spec.name}")
        metrics, finish = observed_metrics(row_rules)
        flat = flat.observe(observation, *metrics)
    found = newest(flat.select(*columns), spec)
    if spec.placed:
        order = [c for c, _ in [spec.split or (None, None)] if c] + [k for k in spec.natural_key]
        df = range_buckets(found, normalize_order(order), f"newest-{spec.name}")
    else:
        df = materialize(found, f"newest-{spec.name}")
    if observation is not None:
        report = finish(observation.get)
        failed = [r for r in report if not r["success"]]
        if failed:
            raise ExpectationError(failed)
    if group_rules:
        check(flatten(raw, spec), group_rules)
    return df


class SharedNewest:
    """Newest versions that several silver jobs take from one raw table: the
    first job parses, gates and deduplicates, the others wait and reuse it."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._found: dict = {}

    def get(self, key, make: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            if key not in self._found:
                self._found[key] = make()
            return self._found[key]


def silver_frame(raw: DataFrame, spec: EntitySpec, run_gate: bool = True,
                 extra_rules: Sequence[Expectation] = (), shared: SharedNewest | None = None) -> DataFrame:
    """The silver table as of a first load: gated, refined rows with surrogate
    keys numbered in natural-key order (key column first).  Jobs that split one
    raw table (same schema and rules) pass the same ``shared``."""
    def make() -> DataFrame:
        return gated_newest(raw, spec, run_gate, extra_rules)

    latest = make() if shared is None else shared.get("first load", make)
    return numbered(latest, spec) if spec.key_col else clean(latest, spec)


INGESTED = "_ingested_at"
VERSION = "_version"


def versions_table(name: str) -> str:
    """Table of the newest version seen of every natural key, also of keys
    that this silver table's filter left out."""
    return f"{name}__versions"


def _newer_only(latest: DataFrame, spec: EntitySpec, store: str, num_buckets: int | None,
                block_rows: int | None = None) -> DataFrame:
    """The rows that are at least as new as what was seen of their key
    before; their versions are stored first (in the table ``store``), so a run
    that died after that accepts the same rows again."""
    keys = list(spec.natural_key)
    version = F.struct(spec.cursor, *spec.tiebreak, RAW_HASH)
    rows = latest.withColumn(VERSION, version)
    if table_exists(latest.sparkSession, store):
        rows = rows.drop(BUCKET, POSITION)      # some may go: those left are numbered anew
        known = read_touched(latest.sparkSession, store, rows, keys).withColumnRenamed(VERSION, "_known")
        rows = rows.join(known, keys, "left") \
            .where(F.col("_known").isNull() | (F.col(VERSION) >= F.col("_known"))).drop("_known")
        rows = materialize(rows, "accepted")
    load_or_upsert(rows.select(*keys, VERSION), store, keys, num_buckets=num_buckets, validate=False,
                   block_rows=block_rows, expected_bytes=stored_bytes(latest), in_order=POSITION in rows.columns)
    return rows.drop(VERSION)


def silver_job(raw: DataFrame, spec: EntitySpec, *args, **options) -> DataFrame:
    """One refresh of a silver table: :func:`stage_silver`, then its publishing
    step.  Returns the published table."""
    return stage_silver(raw, spec, *args, **options)()


def stage_silver(raw: DataFrame, spec: EntitySpec, table: str | None = None,
                 run_gate: bool = True, extra_rules: Sequence[Expectation] = (),
                 incremental: bool = False, num_buckets: int | None = None, ingest_lag_s: int = 0,
                 shared: SharedNewest | None = None, block_rows: int | None = None) -> Callable[[], DataFrame]:
    """Gate and refine a silver refresh.  The step that is returned publishes
    it: create on the first load or upsert keeping surrogate keys (S10 + M4);
    a layer whose jobs are all staged before any is published keeps its old
    versions if one gate fails.

    ``incremental=True`` reads only raw rows whose ``_ingested_at`` is after
    the cursor stored with the table's last version (a pushed-down Parquet
    filter, no JSON parsed for old rows), and with ``num_buckets`` the
    upsert rewrites only the key buckets those rows touch (``block_rows``:
    blocks of consecutive natural keys).  A batch may hold
    older versions than the table: per key, the newest of all versions seen
    wins, whatever the order they arrive in, and an older version neither
    updates nor deletes.  If writers can publish raw rows later than they
    stamp them, ``ingest_lag_s`` reads that much further back; rows seen
    before change nothing.  Completeness rules (expected seasons) are checked
    on the table together with the batch.  Jobs that split one raw table
    (same schema and rules) pass the same ``shared``."""
    name = table or spec.name
    spark = raw.sparkSession
    cursor = last = None
    batch = raw
    completeness: list[DistinctEquals] = []
    if incremental and INGESTED in raw.columns:
        last = TableStore(spark, name).cursor()
        if last is not None:
            batch = raw.where(F.col(INGESTED) > F.timestamp_micros(F.lit(last - ingest_lag_s * 1_000_000)))
        top = batch.agg(F.max(F.unix_micros(F.col(INGESTED))).alias("c")).first()["c"]
        if top is None and last is not None:
            return lambda: read(spark, name)  # nothing new since the last refresh
        cursor = top if last is None else max(top, last)
        if last is not None:
            completeness = [r for r in [*spec.rules, *extra_rules] if isinstance(r, DistinctEquals)]
            # a batch need not cover every expected value: only "no stranger"
            spec = replace(spec, rules=[_subset(r) for r in spec.rules])
            extra_rules = [_subset(r) for r in extra_rules]
    def make() -> DataFrame:
        return gated_newest(batch, spec, run_gate, extra_rules)

    # jobs with the same cursor read the same rows
    latest = make() if shared is None else shared.get((last, cursor), make)
    if run_gate and completeness:
        held = read(spark, name)
        for r in completeness:
            column = spec.renames.get(r.column, r.column)
            both = held.select(column).unionByName(clean(latest, spec).select(column))
            check(both.withColumnRenamed(column, r.column), [r])
    # latest_per_key leaves one row per natural key and the gate rejected
    # NULL keys: the batch needs no second uniqueness check
    gated_keys = run_gate and {k for r in spec.rules if isinstance(r, NotNull) for k in [r.column]} >= set(spec.natural_key)

    def publish() -> DataFrame:
        accepted, delete_keys = latest, None
        if incremental:
            versions = spec.versions if spec.versions and name == spec.name else versions_table(name)

            def accept() -> DataFrame:
                return _newer_only(latest, spec, versions, num_buckets, block_rows)

            # tables split from one raw table see the same versions
            accepted = shared.get((versions, last, cursor), accept) if shared is not None and spec.versions else accept()
            if spec.after_dedup is not None or spec.split is not None:
                # a key whose newest version no longer passes this table's filter
                # (e.g. a result that moved to the other result table) must leave it
                delete_keys = accepted.select(*[F.col(k).alias(spec.renames.get(k, k)) for k in spec.natural_key])
        if spec.key_col and not table_exists(spark, name):
            save(numbered(accepted, spec, TableStore(spark, name).reserve), name, cursor=cursor, num_buckets=num_buckets,
                 bucket_by=spec.key_order[:1] if block_rows else spec.key_order if num_buckets else [], block_rows=block_rows,
                 expected_bytes=stored_bytes(latest), in_order=POSITION in accepted.columns)
            return read(spark, name)
        return load_or_upsert(clean(accepted, spec), name, spec.key_order, key_col=spec.key_col,
                              num_buckets=num_buckets, cursor=cursor, delete_keys=delete_keys,
                              validate=not gated_keys, block_rows=block_rows)
    return publish


def _subset(rule: Expectation) -> Expectation:
    if isinstance(rule, DistinctEquals):
        return InValues(rule.column, rule.values, rule_name=rule.rule_name)
    return rule


def in_parallel(tasks: Mapping[str, Callable[[], DataFrame]], workers: int = 4) -> dict:
    """Run independent Spark jobs from a few driver threads (Spark schedules
    them side by side; FAIR mode shares the cores) and re-raise the first
    failure, so a failed gate still stops the refresh."""
    from concurrent.futures import ThreadPoolExecutor
    from contextvars import copy_context
    if workers <= 1:
        return {k: f() for k, f in tasks.items()}

    def in_pool(name: str, task: Callable[[], DataFrame]) -> DataFrame:
        # a scheduler pool of its own: FAIR shares the cores between pools
        spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return task()

    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {k: pool.submit(copy_context().run, in_pool, k, f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}
