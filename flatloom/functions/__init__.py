"""Column expressions shared by the operators."""

from .columns import (
    bounded_rate,
    epoch_to_timestamp,
    first_number,
    json_field,
    slice_range_start,
    text_flag,
    timestamp_to_epoch,
)

__all__ = [
    "bounded_rate",
    "epoch_to_timestamp",
    "first_number",
    "json_field",
    "slice_range_start",
    "text_flag",
    "timestamp_to_epoch",
]
