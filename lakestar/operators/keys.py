"""Surrogate keys (K1, K2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import global_number


def dense_keys(df: DataFrame, order_by: Sequence, key_col: str,
               start: int | Callable[[int], int] = 1) -> DataFrame:
    """K1: ``key_col = start - 1 + row_number() OVER (ORDER BY order_by)``
    as BIGINT, equal to the global row number but computed with range
    buckets (see :mod:`lakestar.operators.ordered`).  ``order_by`` must be a
    total order (a unique natural key) so that keys are stable across task
    retries and runs.  ``start`` may be a function that is told the number of
    rows and gives the first key (a reservation)."""
    return global_number(df, order_by, key_col, start=start)


def hash_key(*cols: Column | str) -> Column:
    """K2: a deterministic content key: ``md5`` of a single column's text, or
    of several columns' texts, each after its length (``~`` for NULL), so
    different tuples never give the same text."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    if len(parts) == 1:
        return F.md5(parts[0])
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("~"))
                            for p in parts]))
