"""Scalar functions and projections used by the refinement steps."""

from .clean import (NULL_SENTINEL, assemble_datetime, assemble_datetimes, join_text,
                    sentinel_to_null, to_day, try_cast_columns)
from .rename import rename

__all__ = [
    "NULL_SENTINEL", "assemble_datetime", "assemble_datetimes", "join_text",
    "sentinel_to_null", "to_day", "try_cast_columns", "rename",
]
