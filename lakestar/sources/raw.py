"""Raw envelope tables: one JSON string per source row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_COL = "_raw"


def flatten_json(df: DataFrame, schema: T.StructType, payload_col: str = RAW_COL,
                 corrupt_col: str | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """Parse the JSON payload against a declared schema and expand it to
    top-level columns.  Missing or wrongly typed fields come back NULL;
    with ``corrupt_col`` the text of any row that did not parse cleanly is
    kept there.  Catalyst prunes the parse schema to the fields used later."""
    parse_schema = schema
    options = {"mode": "PERMISSIVE"}
    if corrupt_col:
        parse_schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_col
    parsed = F.from_json(F.col(payload_col), parse_schema, options).alias("_rec")
    return df.select(*keep, parsed).select(*keep, "_rec.*")


REASON = "_reason"


def flatten_checked(df: DataFrame, schema: T.StructType, payload_col: str = RAW_COL,
                    keep: Iterable[str] = ()) -> DataFrame:
    """:func:`flatten_json` with the payload and ``_reason``, from the same
    parse: null for a clean row, ``missing`` for a null payload, ``malformed``
    for a text that is no JSON object (cut off, say), ``mistyped`` for an object
    of which a field's value is not of the declared type."""
    corrupt = "_corrupt"
    keep = [c for c in keep if c != payload_col]
    flat = flatten_json(df, schema, payload_col, corrupt_col=corrupt, keep=[payload_col, *keep])
    text = F.col(payload_col)
    reason = F.when(text.isNull(), "missing").when(
        F.col(corrupt).isNotNull(), F.when(F.json_object_keys(text).isNull(), "malformed").otherwise("mistyped")) \
        .when(F.json_object_keys(text).isNull(), "malformed")
    return flat.withColumn(REASON, reason).drop(corrupt)


def quarantine_table(name: str) -> str:
    return f"{name}__quarantine"


def load_checked(df: DataFrame, schema: T.StructType, name: str, max_share: float = 0.01,
                 payload_col: str = RAW_COL) -> tuple[DataFrame, DataFrame]:
    """Parse the payloads once and publish two tables: ``name`` with the typed
    rows, and beside it the quarantine with each text that did not parse, the
    reason, and how many rows hold it.  Rows are counted while they are parsed;
    if more than ``max_share`` of them are corrupt, nothing is published and
    :class:`~lakestar.operators.quality.ExpectationError` is raised.  Without
    rows both tables are empty."""
    from ..operators.quality import ExpectationError
    from .catalog import read, save

    seen = Observation()
    corrupt = F.col(REASON).isNotNull()
    rows = flatten_checked(df, schema, payload_col).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(corrupt).alias("n_bad")).checkpoint(eager=True)
    found = seen.get
    if found["n_bad"] > max_share * found["n_rows"]:
        raise ExpectationError([{"rule_name": "parses", "column": payload_col, **found, "success": False}])
    save(rows.where(~corrupt).drop(payload_col, REASON), name)
    save(rows.where(corrupt).groupBy(F.col(payload_col).alias("text"), F.col(REASON).alias("reason"))
         .agg(F.count(F.lit(1)).alias("n")), quarantine_table(name))
    return read(df.sparkSession, name), read(df.sparkSession, quarantine_table(name))


# Timestamps keep their microseconds in the JSON text (Spark's default
# writer pattern stops at milliseconds).
JSON_WRITE_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def pack_json(df: DataFrame, columns: dict[str, Column | str] | None = None,
              payload_col: str = RAW_COL, keep: Iterable[str] = (),
              options: dict[str, str] | None = None) -> DataFrame:
    """Inverse of :func:`flatten_json`: pack columns (optionally renamed or
    computed, ``{field: expr}``) into one JSON string column."""
    if columns is None:
        fields = [F.col(c) for c in df.columns if c not in set(keep)]
    else:
        fields = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()]
    opts = dict(JSON_WRITE_OPTIONS, **(options or {}))
    return df.select(*keep, F.to_json(F.struct(*fields), opts).alias(payload_col))
