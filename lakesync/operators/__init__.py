"""DataFrame-in, DataFrame-out operators."""

from lakesync.operators.batch import bounded_batch, first_rows, first_rows_sorted, nth_sort_key
from lakesync.operators.checkpoint import (
    Checkpoint,
    high_water_mark,
    latest_checkpoint,
    latest_value_frame,
    max_value_frame,
)
from lakesync.operators.relation import changed_ids, relation_delta, touched_pairs
from lakesync.operators.upsert import (
    DuplicateKeyError,
    align_to,
    assert_unique_keys,
    insert_missing,
    latest_per_key,
    upsert,
)

__all__ = [
    "Checkpoint",
    "DuplicateKeyError",
    "align_to",
    "assert_unique_keys",
    "bounded_batch",
    "changed_ids",
    "first_rows",
    "first_rows_sorted",
    "high_water_mark",
    "insert_missing",
    "latest_checkpoint",
    "latest_per_key",
    "latest_value_frame",
    "max_value_frame",
    "nth_sort_key",
    "relation_delta",
    "touched_pairs",
    "upsert",
]
