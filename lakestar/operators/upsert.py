"""Table upsert without MERGE INTO.

Semantics: target rows whose key is not in the source stay as they are;
matched rows take ``update_cols`` from the source (a NULL in the source
overwrites) and keep the rest; unmatched source rows are inserted with
``insert_cols`` from the source and NULL elsewhere.  Source keys must be
non-NULL and unique.

Plan shape: the source (the new batch) is the build side of every join,
the target is only streamed: ``target LEFT ANTI source`` keeps the
untouched rows, and only when a matched row needs target values is the
matched slice fetched with a ``LEFT SEMI`` join; an upsert that keeps surrogate
keys is one ``LEFT`` join.  When the batch is small
AQE broadcasts it and the target is never shuffled; when it is large the
same plan becomes sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import dense_keys


class UpsertKeyError(ValueError):
    pass


def validate_source_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Duplicate or NULL keys in the batch are an error (partial aggregate,
    one row back at most)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    bad = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")) \
                .where((F.col("_c") > 1) | null_key).limit(1).collect()
    if bad:
        raise UpsertKeyError(f"upsert source has a NULL or duplicate key: {bad[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, insert_cols: Sequence[str] | None = None,
           validate: bool = True, delete_keys: DataFrame | None = None) -> DataFrame:
    """M1/M2/M3.  ``update_cols=None`` and ``insert_cols=None`` mean every
    column (full-row upsert); ``update_cols=[], insert_cols=keys`` is the
    key-only merge.  Target rows whose key is in ``delete_keys`` but not in
    the source are removed (MERGE ... WHEN MATCHED THEN DELETE).  Output
    has the target's columns and order."""
    keys = list(keys)
    cols = target.columns
    upd = set(cols if update_cols is None else update_cols) | set(keys)
    ins = set(cols if insert_cols is None else insert_cols) | set(keys)
    missing = [c for c in (upd | ins) if c not in source.columns]
    if missing:
        raise ValueError(f"upsert: source lacks columns {missing}")
    if validate:
        validate_source_keys(source, keys)

    src_keys = source.select(*keys)
    gone = src_keys if delete_keys is None else src_keys.unionByName(delete_keys.select(*keys))
    untouched = target.join(gone, keys, "left_anti")
    keep_from_target = [c for c in cols if c not in upd]
    full_row = not keep_from_target and ins == set(cols)
    if full_row:
        changed = source.select(*cols)
    else:
        matched = target.join(src_keys, keys, "left_semi") \
                        .select(*keys, *keep_from_target, F.lit(True).alias("_m"))
        renamed = [F.col(c).alias(f"_t_{c}") for c in keep_from_target]
        j = source.join(matched.select(*keys, *renamed, "_m"), keys, "left")
        hit = F.col("_m").isNotNull()
        out = []
        for c in cols:
            if c in keys:
                out.append(F.col(c))
                continue
            on_match = F.col(c) if c in upd else F.col(f"_t_{c}")
            on_insert = F.col(c) if c in ins else F.lit(None).cast(target.schema[c].dataType)
            out.append(F.when(hit, on_match).otherwise(on_insert).cast(target.schema[c].dataType).alias(c))
        changed = j.select(*out)
    return untouched.select(*cols).unionByName(changed)


def upsert_with_key(target: DataFrame, source: DataFrame, keys: Sequence[str], key_col: str,
                    validate: bool = True, start: int | Callable[[int], int] | None = None,
                    delete_keys: DataFrame | None = None) -> DataFrame:
    """M4: upsert that preserves surrogate keys.  Matched rows keep their
    key, new natural keys get ``max(key) + 1, ...`` in natural-key order
    (``start`` overrides the first new key, e.g. when ``target`` is only
    the touched part of a table; as a function it is told how many are new and
    reserves them).  New keys are found and numbered as keys alone; the
    target's rows meet the batch in one join."""
    keys = list(keys)
    cols = target.columns
    data_cols = [c for c in cols if c != key_col]
    if validate:
        validate_source_keys(source, keys)
    src = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in data_cols])
    if start is None:
        start = (target.agg(F.max(key_col).alias("m")).first()["m"] or 0) + 1
    new = dense_keys(src.select(*keys).join(target.select(*keys), keys, "left_anti"), keys, key_col, start=start)
    others = [c for c in data_cols if c not in keys]
    changes = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in others], F.lit(True).alias("_hit"))
    if delete_keys is not None:
        gone = delete_keys.select(*keys).distinct().join(src.select(*keys), keys, "left_anti")
        changes = changes.unionByName(gone.withColumn("_hit", F.lit(False)), allowMissingColumns=True)
    hit = F.col("_hit").isNotNull()
    have = target.join(changes, keys, "left").where(~hit | F.col("_hit")) \
        .select(*[F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in others else F.col(c) for c in cols])
    return have.unionByName(new.join(src, keys).select(*cols))
