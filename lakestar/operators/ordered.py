"""Global order without a single-partition sort.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY moves every row to
one task.  Instead the shuffle's own range partitioning cuts the order into
contiguous partitions (sampled boundaries, as many partitions as the session's
shuffles have, merged by AQE when they are small); each partition is sorted
and its rows are numbered where they lie.  The numbered rows are written once
to the shared scratch folder, so every later reader sees the same numbers
and none repeats the sort.  Row counts per partition, one row per shuffle
partition, become offsets: ``offset + position`` is the global row number.

There is one path for every size.  A sort key that many rows share stays in
one partition: callers number by a total order (a unique natural key).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BUCKET = "_rb"
POSITION = "_rb_pos"
OFFSET = "_rb_off"

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def normalize_order(order_by: Sequence[str | tuple[str, bool] | tuple[str, str]]) -> list[tuple[str, bool]]:
    out = []
    for o in order_by:
        if isinstance(o, str):
            out.append((o, True))
        else:
            c, d = o
            out.append((c, d if isinstance(d, bool) else str(d).lower() != "desc"))
    return out


def sort_exprs(order: Order) -> list[Column]:
    """Spark's default null placement: NULLS FIRST asc, NULLS LAST desc."""
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def range_buckets(df: DataFrame, order: Order, purpose: str = "ordered") -> DataFrame:
    """Add :data:`BUCKET` (the range partition, ascending in ``order``) and
    :data:`POSITION` (place within it, from 0); written to the scratch
    folder.  ``monotonically_increasing_id`` holds the partition in its upper
    31 bits and the place in its lower 33."""
    by = sort_exprs(order)
    placed = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn(POSITION, F.monotonically_increasing_id()), purpose)
    return placed.withColumns({BUCKET: F.shiftright(POSITION, 33).cast("int"),
                               POSITION: F.col(POSITION).bitwiseAND((1 << 33) - 1)})


def number_placed(rows: DataFrame, out_col: str, start: int | Callable[[int], int] = 1) -> DataFrame:
    """Number rows that :func:`range_buckets` has placed, from ``start`` on, or
    those of them that stand next to one another in each of its partitions."""
    # one row per shuffle partition reaches the driver
    spans = {r.b: r for r in rows.groupBy(F.col(BUCKET).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(POSITION).alias("low")).collect()}
    if callable(start):             # told the number of rows
        start = start(sum(r.n for r in spans.values()))
    # by bucket number, as an array: a join would hide the rows' size from the planner
    buckets = range(max(spans, default=-1) + 1)
    before = accumulate((spans[b].n if b in spans else 0 for b in buckets), initial=start)
    offsets = [n - (spans[b].low if b in spans else 0) for b, n in zip(buckets, before)]
    offset = F.get(F.lit(offsets).cast("array<bigint>"), F.col(BUCKET))
    return rows.withColumn(out_col, offset + F.col(POSITION)).drop(BUCKET, POSITION)


def bucket_offsets(rows: DataFrame, partition_cols: Sequence[str], weight_col: str | None) -> DataFrame:
    """What the same partition holds in earlier buckets: an exclusive running
    sum over one row per (bucket, partition)."""
    amount = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    counts = rows.groupBy(BUCKET, *partition_cols).agg(amount.alias("_n"))
    w = Window.partitionBy(*partition_cols).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(OFFSET, F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("bigint")).drop("_n")


def global_number(df: DataFrame, order_by, out_col: str, start: int | Callable[[int], int] = 1,
                  partition_cols: Sequence[str] = (), method: str = "row_number",
                  weight_col: str | None = None) -> DataFrame:
    """``start - 1 + row_number()/rank() OVER (PARTITION BY partition_cols
    ORDER BY order_by)``, never in one task.  ``partition_cols`` are put
    before the order, so each bucket covers a contiguous run of partitions
    and a large partition is spread over many.  ``method='prefix'`` gives
    ``start - 1 +`` the sum of ``weight_col`` over the rows strictly before
    (the order must then be a total order)."""
    order = normalize_order(order_by)
    if method == "row_number" and not partition_cols:
        return number_placed(range_buckets(df, order), out_col, start)
    full = [(c, True) for c in partition_cols] + [o for o in order if o[0] not in partition_cols]
    rows = range_buckets(df, full).drop(POSITION)
    offsets = bucket_offsets(rows, partition_cols, weight_col if method == "prefix" else None)
    # null-safe on the partition columns: a NULL season is a partition too
    renamed = offsets.select(F.col(BUCKET).alias("_o" + BUCKET), F.col(OFFSET),
                             *[F.col(c).alias("_o_" + c) for c in partition_cols])
    cond = [F.col(BUCKET) == F.col("_o" + BUCKET)] + \
           [F.col(c).eqNullSafe(F.col("_o_" + c)) for c in partition_cols]
    w = Window.partitionBy(BUCKET, *partition_cols).orderBy(*sort_exprs(order))
    if method == "prefix":
        over = F.coalesce(F.sum(weight_col).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        over = {"row_number": F.row_number, "rank": F.rank}[method]().over(w)
    out = rows.join(renamed, cond, "inner") \
              .withColumn(out_col, (F.col(OFFSET) + over + F.lit(start - 1)).cast("bigint"))
    return out.drop(BUCKET, OFFSET, "_o" + BUCKET, *["_o_" + c for c in partition_cols])
