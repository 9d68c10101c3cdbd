"""Extract modes of the sync step (S4-S6): incremental append by cursor,
full refresh, and a partitioned JDBC reader for relational sources."""

from __future__ import annotations

import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import TableStore, read, save, table_exists


def cursor_filter(src: DataFrame, cursor_col: str, last_cursor: Any) -> DataFrame:
    """Rows strictly after the last synced cursor.  The literal is cast to
    the column type so the predicate reaches the Parquet scan
    (``PushedFilters: GreaterThan``).  Rows that were committed later with this
    cursor value or an earlier one are the business of :func:`late_rows`."""
    if last_cursor is None:
        return src
    dtype = src.schema[cursor_col].dataType
    return src.filter(F.col(cursor_col) > F.lit(last_cursor).cast(dtype))


def late_rows(src: DataFrame, target: DataFrame, cursor_col: str, since: Any, until: Any) -> DataFrame:
    """Source rows with a cursor from ``since`` to ``until``, both included,
    that the target does not hold: a multiset difference over that window, so
    repeated rows arrive as often as the source has them.  Both sides are
    pushed-down range filters.  A null cursor never changes and is synced
    first."""
    kind = src.schema[cursor_col].dataType
    inside = F.col(cursor_col).between(F.lit(since).cast(kind), F.lit(until).cast(kind))
    return src.filter(inside).exceptAll(target.select(*src.columns).filter(inside))


def incremental_extract(src: DataFrame, cursor_col: str,
                        last_cursor: Any = None) -> tuple[DataFrame, Any]:
    """The new batch (lazy) and the cursor to store after it is loaded:
    ``max(cursor)`` of the batch, or the old cursor when nothing is new.
    The max is one partial/final aggregate, never a collect of rows.  The batch
    ends at that cursor, so rows that reach a live source between the two jobs
    are left to the next batch."""
    batch = cursor_filter(src, cursor_col, last_cursor)
    top = batch.agg(F.max(cursor_col).alias("c")).first()["c"]
    if top is None:
        return batch.filter(F.col(cursor_col).isNull()) if last_cursor is None else batch.limit(0), last_cursor
    closed = F.col(cursor_col) <= F.lit(top).cast(src.schema[cursor_col].dataType)
    return batch.filter(closed if last_cursor is not None else closed | F.col(cursor_col).isNull()), top


_EPOCH = datetime.datetime(1970, 1, 1)


def _encode(value: Any) -> int | None:
    """Cursor state as an integer marker (integral or naive-timestamp cursors)."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime) and value.tzinfo is None:
        return (value - _EPOCH) // datetime.timedelta(microseconds=1)
    return None


def _decode(marker: int, dtype: T.DataType) -> Any:
    if isinstance(dtype, T.IntegralType):
        return marker
    if isinstance(dtype, T.TimestampNTZType):
        return _EPOCH + datetime.timedelta(microseconds=marker)
    return None


def sync_incremental(spark: SparkSession, src: DataFrame, name: str, cursor_col: str,
                     lag: Any = 0) -> tuple[int | None, Any]:
    """Incremental-append sync into a raw table, whose cursor is kept with the
    table.  A sync takes the closed window from the last cursor less ``lag`` (a
    number, or seconds for a timestamp) to the newest cursor, and leaves out
    what the target already holds of it.  So rows that tie with the last cursor
    and rows that were committed up to ``lag`` below it arrive once, and a sync
    that died after its rows were appended, but before its cursor was stored,
    repeats nothing.  Of either side only that window is read.  Cursor types
    without an integer form fall back to the target's ``max(cursor)``."""
    if not table_exists(spark, name):
        batch, new_cursor = incremental_extract(src, cursor_col)
        save(batch, name, mode="append", cursor=_encode(new_cursor))
        return 1, new_cursor
    target = read(spark, name)
    marker = TableStore(spark, name).cursor()
    last = _decode(marker, src.schema[cursor_col].dataType) if marker is not None else None
    if last is None:
        last = target.agg(F.max(cursor_col).alias("c")).first()["c"]
    _, new_cursor = incremental_extract(src, cursor_col, last)
    if new_cursor is None:
        return None, None
    since = last if last is not None else src.agg(F.min(cursor_col).alias("c")).first()["c"]
    if lag:
        since -= datetime.timedelta(seconds=lag) if isinstance(since, datetime.datetime) else lag
    batch = late_rows(src, target, cursor_col, since, new_cursor).checkpoint(eager=True)
    if new_cursor == last and batch.isEmpty():
        return None, last
    save(batch, name, mode="append", cursor=_encode(new_cursor))
    return 1, new_cursor


def full_refresh(src: DataFrame, name: str) -> DataFrame:
    """Replace the target with the whole source (new snapshot)."""
    save(src, name, mode="overwrite")
    return read(src.sparkSession, name)


def jdbc_source(spark: SparkSession, url: str, table: str, partition_column: str,
                lower_bound: int, upper_bound: int, num_partitions: int,
                properties: dict[str, str] | None = None) -> DataFrame:
    """A relational table read in ``num_partitions`` parallel range
    slices of ``partition_column`` (the source's integer primary key)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties or {})
