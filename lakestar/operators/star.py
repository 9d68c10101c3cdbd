"""Star-schema joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_keys(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, key_col: str,
                how: str = "inner", keep_natural: bool = False) -> DataFrame:
    """Replace a natural id in ``fact`` by the dimension's surrogate key.
    Only ``[dim_col, key_col]`` are taken from the dimension, so its other
    columns can never collide with the fact's.  ``how='inner'`` drops
    orphans (J2); the join strategy is left to AQE, which broadcasts the
    dimension only when its measured size is under the threshold."""
    d = dim.select(F.col(dim_col).alias("_lk"), F.col(key_col))
    out = fact.join(d, fact[fact_col] == d["_lk"], how).drop("_lk")
    return out if keep_natural else out.drop(fact_col)


def join_dimension(left: DataFrame, dim: DataFrame, on: str | Sequence[str],
                   columns: Sequence[str] | Mapping[str, str], how: str = "inner",
                   dim_on: str | Sequence[str] | None = None) -> DataFrame:
    """Attach chosen dimension columns (a list, or ``{dim_col:
    alias}``) by an equi-join; ``how='left'`` keeps unmatched rows with NULL
    attributes."""
    lk = [on] if isinstance(on, str) else list(on)
    rk = lk if dim_on is None else ([dim_on] if isinstance(dim_on, str) else list(dim_on))
    pairs = columns.items() if isinstance(columns, Mapping) else [(c, c) for c in columns]
    d = dim.select(*[F.col(r).alias(f"_jk{i}") for i, r in enumerate(rk)],
                   *[F.col(c).alias(a) for c, a in pairs])
    cond = [left[l] == d[f"_jk{i}"] for i, l in enumerate(lk)]
    return left.join(d, cond, how).drop(*[f"_jk{i}" for i in range(len(rk))])
