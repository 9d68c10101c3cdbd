"""Renames (P1)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename many columns in one projection.  Unlike chained renames
    this is simultaneous, so ``{a: b, b: a}`` swaps; clashing or unknown
    names raise instead of silently producing duplicate columns."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"rename: unknown columns {missing}")
    out = [mapping.get(c, c) for c in df.columns]
    if len(set(out)) != len(out):
        raise ValueError(f"rename: duplicate output names in {out}")
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])
