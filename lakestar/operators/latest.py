"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                   tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    """Keep the first row per key under ``order_by`` (strings mean
    descending: newest first) and then ``tiebreak``.  Planned as
    ``row_number() = 1``; Spark inserts a partial ``WindowGroupLimit`` before
    the shuffle, so each map task forwards at most one row per key and a
    hot key costs the reducer one row per map task, not its whole history."""
    orders = [F.col(o).desc() if isinstance(o, str) else o for o in [*order_by, *tiebreak]]
    w = Window.partitionBy(*keys).orderBy(*orders)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
