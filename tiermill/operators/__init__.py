"""DataFrame operators: deduplication, global order, lookups, conversion and quality checks."""

from tiermill.operators.conform import conform, require_non_empty, stamp
from tiermill.operators.dedup import keep_first, require_key
from tiermill.operators.lookup import lookup_join, lookup_key, lookup_pair
from tiermill.operators.ordered import running_max_fill, surrogate_key, version_end_date
from tiermill.operators.quality import (
    Check,
    dq_report,
    enforce,
    in_domain,
    non_negative,
    orphan_keys,
    repeated_keys,
    row_difference,
    unique_not_null,
    unparsed,
    valid_date_int,
)

__all__ = [
    "Check",
    "conform",
    "dq_report",
    "enforce",
    "in_domain",
    "keep_first",
    "lookup_join",
    "lookup_key",
    "lookup_pair",
    "non_negative",
    "orphan_keys",
    "require_key",
    "repeated_keys",
    "require_non_empty",
    "row_difference",
    "running_max_fill",
    "stamp",
    "surrogate_key",
    "unique_not_null",
    "unparsed",
    "valid_date_int",
    "version_end_date",
]
