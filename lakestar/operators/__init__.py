"""User-level DataFrame operators."""

from .keys import dense_keys, hash_key
from .latest import latest_per_key
from .ordered import global_number
from .quality import (DistinctEquals, ExpectationError, InSetOf, InValues, LengthBetween, NotNull,
                      Unique, ValueBetween, check, enforce, evaluate)
from .ranking import (champions, count_distinct_by, incident_counts, season_totals, standings,
                      top_k)
from .report import attach_dimensions, union_tagged
from .star import join_dimension, lookup_keys
from .upsert import UpsertKeyError, upsert, upsert_with_key

__all__ = [
    "dense_keys", "hash_key", "latest_per_key", "global_number",
    "DistinctEquals", "ExpectationError", "InSetOf", "InValues", "LengthBetween", "NotNull", "Unique",
    "ValueBetween", "check", "enforce", "evaluate", "champions", "count_distinct_by",
    "incident_counts", "season_totals", "standings", "top_k", "attach_dimensions",
    "union_tagged", "join_dimension", "lookup_keys", "UpsertKeyError", "upsert",
    "upsert_with_key",
]
