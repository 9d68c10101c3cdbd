"""Data-quality expectations.

Each rule yields one row ``(rule_name, column, n_rows, n_bad, success)``.
Row-level rules (not-null, value/length between) share one aggregation
pass over the data (or are observed during a write, see
:func:`observed_metrics`).  Set-level rules (distinct set, reference,
uniqueness) are joins and aggregations, never a set collected to the
driver.  :func:`enforce` is the gate: one action over the small result
frame, then raise if any rule failed.

NULL rule: value/length/set/reference rules ignore NULLs; not-null catches
them; uniqueness counts NULL as a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("rule_name", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_bad", T.LongType()),
    T.StructField("success", T.BooleanType()),
])


class ExpectationError(Exception):
    """Raised by the gate; carries the failed rule rows."""

    def __init__(self, failed: Sequence[dict]):
        super().__init__(f"{len(failed)} expectation(s) failed: {list(failed)}")
        self.failed = list(failed)


class Expectation:
    rule_name: str = ""
    column: str = ""
    row_level = False

    def bad(self) -> Column:  # row-level rules only
        raise NotImplementedError

    def metric(self) -> Column:
        """Aggregate giving ``n_bad`` in one pass (row-level rules)."""
        return F.count_if(self.bad())

    def observable(self) -> "Expectation | None":
        """A single-pass (aggregate-only) equivalent, or None if the rule
        needs a join.  Used to check rules while the data streams through
        another job instead of scanning it again."""
        return self if self.row_level else None

    def evaluate(self, df: DataFrame) -> DataFrame:
        """Set-level rules: a one-row frame ``(n_rows, n_bad)``."""
        raise NotImplementedError


class NotNull(Expectation):
    """No NULL in the column (primary or foreign key)."""
    row_level = True

    def __init__(self, column: str):
        self.column = column
        self.rule_name = "not_null"

    def bad(self) -> Column:
        return F.col(self.column).isNull()


class ValueBetween(Expectation):
    """``lo <= value <= hi`` (the intended range check)."""
    lo: Any = None
    hi: Any = None
    row_level = True

    def __init__(self, column: str, lo: Any, hi: Any):
        self.column, self.lo, self.hi = column, lo, hi
        self.rule_name = "value_between"

    def bad(self) -> Column:
        c = F.col(self.column)
        return F.coalesce(~c.between(F.lit(self.lo), F.lit(self.hi)), F.lit(False))


class LengthBetween(Expectation):
    """Length of the value's text between bounds (the check the
    reference's circuit job literally runs on latitude/longitude)."""
    lo: int = 0
    hi: int = 0
    row_level = True

    def __init__(self, column: str, lo: int, hi: int):
        self.column, self.lo, self.hi = column, lo, hi
        self.rule_name = "length_between"

    def bad(self) -> Column:
        n = F.length(F.col(self.column).cast("string"))
        return F.coalesce(~n.between(F.lit(self.lo), F.lit(self.hi)), F.lit(False))


class DistinctEquals(Expectation):
    """E5/A2: the set of distinct non-NULL values equals ``values``, as one
    aggregate.  ``n_bad`` = rows with a value that is not expected + expected
    values that are absent."""
    values: tuple = ()
    row_level = True

    def __init__(self, column: str, values: Iterable):
        self.column, self.values = column, tuple(values)
        self.rule_name = "distinct_equals"

    def bad(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~c.isin(list(self.values))

    def metric(self) -> Column:
        # the collected set only holds expected values: bounded by the rule
        c = F.col(self.column)
        seen = F.size(F.collect_set(F.when(c.isin(list(self.values)), c)))
        return F.count_if(self.bad()) + (F.lit(len(set(self.values))) - seen)


class InSetOf(Expectation):
    """Every non-NULL value appears in ``other[other_column]``
    (referential integrity).  A left join against the distinct referenced
    keys, not a driver-side set."""
    other: Any = None
    other_column: str = ""

    def __init__(self, column: str, other: DataFrame, other_column: str | None = None):
        self.column, self.other, self.other_column = column, other, other_column or column
        self.rule_name = "in_set_of"

    def evaluate(self, df: DataFrame) -> DataFrame:
        ref = self.other.select(F.col(self.other_column).alias("_ref")).distinct() \
                  .withColumn("_hit", F.lit(True))
        j = df.select(F.col(self.column).alias("_ref")).join(ref, "_ref", "left")
        return j.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if(F.col("_ref").isNotNull() & F.col("_hit").isNull()).alias("n_bad"))


    def joined(self, df: DataFrame, flag: str) -> tuple[DataFrame, "Expectation"]:
        """The rows with a flag whether their value is known, and this rule as
        a row-level one on that flag: it can then be observed in the job that
        computes the rows, which are scanned once."""
        ref = self.other.select(F.col(self.other_column).alias(f"{flag}_ref")).distinct().withColumn(flag, F.lit(True))
        out = df.join(ref, F.col(self.column) == F.col(f"{flag}_ref"), "left").drop(f"{flag}_ref")
        return out, _Flagged(self, flag)


class _Flagged(Expectation):
    """A reference rule on rows that carry its flag."""
    row_level = True

    def __init__(self, rule: InSetOf, flag: str):
        self.rule_name, self.column, self.flag = rule.rule_name, rule.column, flag

    def bad(self) -> Column:
        return F.col(self.column).isNotNull() & F.col(self.flag).isNull()


class InValues(Expectation):
    """Every non-NULL value is one of the given values (a literal set, sized
    by the caller: a rule parameter or a bounded probe of another table)."""
    row_level = True

    def __init__(self, column: str, values: Iterable, rule_name: str = "in_values"):
        self.column, self.values = column, list(values)
        self.rule_name = rule_name

    def bad(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~c.isin(self.values)


class Unique(Expectation):
    """No two rows share the key; ``n_bad`` = number of duplicated keys."""
    columns: tuple = ()

    def __init__(self, *columns: str):
        self.columns = tuple(columns)
        self.column = ",".join(columns)
        self.rule_name = "unique"

    def evaluate(self, df: DataFrame) -> DataFrame:
        per_key = df.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_c"))
        return per_key.agg(F.sum("_c").cast("bigint").alias("n_rows"),
                           F.count_if(F.col("_c") > 1).alias("n_bad"))


def _row_level_frame(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_rows")] + \
           [r.metric().alias(f"b{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{r.rule_name}', '{r.column}', b{i}" for i, r in enumerate(rules))
    return one.selectExpr("n_rows", f"stack({len(rules)}, {stack}) as (rule_name, column, n_bad)")


def evaluate(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """All rules together as a small result frame (lazy)."""
    rows = [r for r in expectations if r.row_level]
    sets = [r for r in expectations if not r.row_level]
    parts: list[DataFrame] = []
    if rows:
        parts.append(_row_level_frame(df, rows))
    for r in sets:
        parts.append(r.evaluate(df).select(F.lit(r.rule_name).alias("rule_name"),
                                           F.lit(r.column).alias("column"), "n_rows", "n_bad"))
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("rule_name", "column", F.col("n_rows").cast("bigint").alias("n_rows"),
                      F.col("n_bad").cast("bigint").alias("n_bad"),
                      (F.col("n_bad") == 0).alias("success"))


def enforce(results: DataFrame) -> list[dict]:
    """Evaluate the (small) result frame once; raise on any failure."""
    report = [r.asDict() for r in results.collect()]
    failed = [r for r in report if not r["success"]]
    if failed:
        raise ExpectationError(failed)
    return report


def check(df: DataFrame, expectations: Sequence[Expectation]) -> list[dict]:
    return enforce(evaluate(df, expectations)) if expectations else []


def observed_metrics(expectations: Sequence[Expectation]) -> tuple[list[Column], Callable]:
    """Row-level rules as ``observe`` metrics, to be collected during a
    write.  Returns the metric columns and a function that turns the
    observed dict into result rows."""
    rows = [r for r in expectations if r.row_level]
    if len(rows) != len(expectations):
        raise ValueError("only row-level expectations can be observed during a write")
    metrics = [F.count(F.lit(1)).alias("n_rows")] + \
              [r.metric().cast("bigint").alias(f"b{i}") for i, r in enumerate(rows)]

    def finish(values: dict) -> list[dict]:
        return [{"rule_name": r.rule_name, "column": r.column, "n_rows": values["n_rows"],
                 "n_bad": values[f"b{i}"], "success": values[f"b{i}"] == 0}
                for i, r in enumerate(rows)]

    return metrics, finish
