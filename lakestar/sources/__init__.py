"""Sources and sinks: raw JSON envelopes, incremental extracts, and the
partitioned tables behind the name registry."""

from .raw import RAW_COL, flatten_checked, flatten_json, load_checked, pack_json
from .scan import scan
from .extract import full_refresh, incremental_extract, jdbc_source
from .catalog import (TableStore, compact, ensure_table, load_or_upsert, read, read_buckets, read_touched, register, replace_buckets, replace_table,
                      save, sql_with_registry, table_exists, touched_buckets, vacuum)
from .layout import cluster_by, read_bucketed, save_bucketed

__all__ = [
    "cluster_by", "read_bucketed", "save_bucketed",
    "RAW_COL", "scan", "flatten_checked", "flatten_json", "load_checked", "pack_json", "full_refresh", "incremental_extract",
    "jdbc_source", "TableStore", "compact", "ensure_table", "load_or_upsert", "read", "read_buckets", "read_touched", "register", "replace_buckets", "replace_table",
    "save", "sql_with_registry", "table_exists", "touched_buckets", "vacuum",
]
