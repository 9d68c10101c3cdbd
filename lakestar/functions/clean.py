"""Scalar cleaning functions (F1-F9).  All are built-in Column expressions:
they stay inside whole-stage codegen, no Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the source's text marker for a missing value.
NULL_SENTINEL = "\\N"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(df: DataFrame, columns: Iterable[str], sentinel: str = NULL_SENTINEL) -> DataFrame:
    """the sentinel string becomes NULL on the chosen columns."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns})


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text -> int / long / float / double; unparsable text is NULL
    instead of an ANSI cast error (the sentinel included, so a column that
    was not listed for sentinel replacement is safe too)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def assemble_datetime(date: Column | str, time: Column | str,
                      as_type: str = "timestamp_ntz") -> Column:
    """date + time text -> timestamp.  A known date with a missing
    time is midnight; a missing date is NULL; bad text is NULL."""
    d, t = _c(date), _c(time)
    text = F.when(d.isNull(), F.lit(None).cast("string")) \
            .when(t.isNull(), F.concat(d.cast("string"), F.lit(" 00:00:00"))) \
            .otherwise(F.concat(d.cast("string"), F.lit(" "), t))
    return text.try_cast(as_type)


def assemble_datetimes(df: DataFrame, parts: Mapping[str, tuple[str, str]],
                       as_type: str = "timestamp_ntz") -> DataFrame:
    """Several date/time pairs at once: ``{out: (date_col, time_col)}``."""
    return df.withColumns({out: assemble_datetime(d, t, as_type) for out, (d, t) in parts.items()})


def join_text(*parts: Column | str, sep: str = " ") -> Column:
    """``a || sep || b``; NULL if any part is NULL (``concat``, not
    ``concat_ws``, which would skip NULLs)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p))
    return F.concat(*cols)


def to_day(ts: Column | str) -> Column:
    """timestamp -> date."""
    return F.to_date(_c(ts))
