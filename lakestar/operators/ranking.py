"""Season questions over the report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ordered import global_number


def season_totals(report: DataFrame, season_col: str, competitor_col: str, points_col: str,
                  win: Column, points_type: str = "decimal(18,2)") -> DataFrame:
    """Points and wins per (season, competitor).  Partial aggregation runs
    before the shuffle, so a competitor with most of the rows costs one row
    per map task.  Points are summed as exact decimals (order-independent)."""
    return report.groupBy(F.col(season_col).alias("race_year"),
                          F.col(competitor_col).alias("competitor")) \
                 .agg(F.sum(F.col(points_col)).cast(points_type).alias("total_points"),
                      F.sum(F.when(win, 1).otherwise(0)).cast("bigint").alias("wins"))


def standings(totals: DataFrame) -> DataFrame:
    """Q3/Q4: ``rank() OVER (PARTITION BY race_year ORDER BY total_points
    DESC, wins DESC)`` as ``season_rank``.

    Ties make rank a function of the score alone: rank = 1 + number of
    competitors of the season with a strictly better (points, wins).  So
    the season's score histogram (partial aggregate: a score shared by a
    third of all competitors is still one row) gets an exclusive running
    sum of its counts - range-bucketed, never one task per season - and
    the result joins back on (season, points, wins), many-to-one (AQE
    broadcasts the histogram when small, else splits a hot score's
    partition)."""
    totals = materialize(totals, "totals")      # small next to the facts, read twice
    hist = totals.groupBy("race_year", "total_points", "wins").agg(F.count(F.lit(1)).alias("_n"))
    ranked = global_number(hist, [("total_points", False), ("wins", False)], "season_rank",
                           partition_cols=["race_year"], method="prefix", weight_col="_n",
                           start=2).drop("_n")
    r = ranked.select(*[F.col(c).alias(f"_h_{c}") for c in ["race_year", "total_points", "wins"]],
                      "season_rank")
    cond = [totals[c].eqNullSafe(r[f"_h_{c}"]) for c in ["race_year", "total_points", "wins"]]
    return totals.join(r, cond, "inner").select(*totals.columns, "season_rank")


def champions(totals: DataFrame) -> DataFrame:
    """Q1/Q2: competitors with the best (points, wins) of their season:
    a max per season (partial aggregate, one row per season) joined back on
    (season, points, wins); shared first places all appear, as with rank 1."""
    best = totals.groupBy("race_year").agg(
        F.max(F.struct("total_points", "wins")).alias("_best"))
    best = best.select("race_year", F.col("_best.total_points").alias("_bp"),
                       F.col("_best.wins").alias("_bw"))
    cond = [totals["race_year"].eqNullSafe(best["race_year"]),
            totals["total_points"] == best["_bp"], totals["wins"] == best["_bw"]]
    return totals.join(best, cond, "left_semi")


def count_distinct_by(df: DataFrame, group_col: str, distinct_col: str, out_col: str) -> DataFrame:
    """Q5: distinct count per group (Spark plans it as a two-level
    aggregate keyed by (group, value) first, so big groups are spread)."""
    return df.groupBy(group_col).agg(F.countDistinct(distinct_col).alias(out_col))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """O3: ``ORDER BY ... LIMIT k`` -> TakeOrderedAndProject (a per-task
    top-k heap, then a k-row merge)."""
    return df.orderBy(*order).limit(k)


def incident_counts(report: DataFrame, group_col: str, status_col: str,
                    incident_statuses: Iterable[str], with_rate: bool = False) -> DataFrame:
    """Q6: starts and incidents per group; incidents are rows whose status
    is in the given set (a parameter, e.g. accident / collision)."""
    statuses = list(incident_statuses)
    out = report.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("starts"),
        F.sum(F.when(F.col(status_col).isin(statuses), 1).otherwise(0)).cast("bigint").alias("incidents"))
    if with_rate:
        out = out.withColumn("incident_rate", F.col("incidents") / F.col("starts"))
    return out
