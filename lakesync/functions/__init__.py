"""Column expressions: checkpoint and window predicates, typed literals."""

from lakesync.functions.windows import (
    between_half_open,
    column_type,
    lagged_range,
    literal_text,
    previous_day,
    run_date_suffix,
    since,
    typed_lit,
    value_text,
)

__all__ = [
    "between_half_open",
    "column_type",
    "lagged_range",
    "literal_text",
    "previous_day",
    "run_date_suffix",
    "since",
    "typed_lit",
    "value_text",
]
