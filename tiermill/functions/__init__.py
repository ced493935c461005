"""Column expressions that clean and standardise one value at a time."""

from tiermill.functions.cleaning import (
    null_future_dates,
    numeric_default,
    prefer_master,
    reconcile_amounts,
    remove_chars,
    sentinel_timestamp,
    split_product_key,
    standardize_codes,
    strip_prefix,
    trim_columns,
    yyyymmdd_to_timestamp,
)

__all__ = [
    "null_future_dates",
    "numeric_default",
    "prefer_master",
    "reconcile_amounts",
    "remove_chars",
    "sentinel_timestamp",
    "split_product_key",
    "standardize_codes",
    "strip_prefix",
    "trim_columns",
    "yyyymmdd_to_timestamp",
]
