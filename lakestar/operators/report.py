"""Tagged union of facts and the denormalised report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .star import join_dimension


def union_tagged(parts: Mapping[str, DataFrame], tag_col: str,
                 renames: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """``UNION ALL`` of frames after renaming each one's columns to a
    common name and adding a constant tag column (``lit``, constant-folded)."""
    out = None
    for tag, df in parts.items():
        mapping = (renames or {}).get(tag, {})
        cols = [F.col(c).alias(mapping.get(c, c)) for c in df.columns]
        part = df.select(*cols, F.lit(tag).alias(tag_col))
        out = part if out is None else out.unionByName(part)
    return out


def attach_dimensions(base: DataFrame,
                      dims: Sequence[tuple[DataFrame, str | Sequence[str], Sequence[str] | Mapping[str, str],
                                           str | Sequence[str] | None]]
                      ) -> DataFrame:
    """Left-join chain; each ``(dim, base_on, columns, dim_on)`` adds
    ``columns`` (list or ``{dim_col: alias}``) and keeps facts without a
    dimension row (NULL attributes)."""
    out = base
    for dim, on, columns, dim_on in dims:
        out = join_dimension(out, dim, on, columns, how="left", dim_on=dim_on)
    return out
