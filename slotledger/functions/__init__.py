"""Column expressions shared by the operators."""

from slotledger.functions.columns import (
    as_day,
    balance_tags,
    exact_number,
    join_text,
    last_segment,
    loses_digits,
    month_key,
    movement_parts,
    named_value,
    nulls_last,
    occupancy,
    operation_tags,
)

__all__ = [
    "as_day", "balance_tags", "exact_number", "join_text", "last_segment", "loses_digits", "month_key", "movement_parts",
    "named_value", "nulls_last", "occupancy", "operation_tags",
]
