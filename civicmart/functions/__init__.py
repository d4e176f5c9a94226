"""Column-level building blocks."""

from .cleaning import (
    ColumnRule,
    apply_rules,
    apply_rules_beside_raw,
    fill_zero,
    hyphens_to_spaces,
    rejected_counts,
    safe_ratio,
    text_to_null,
    to_double,
    to_int,
)
from .keys import hash_bucket

__all__ = [
    "ColumnRule",
    "apply_rules",
    "apply_rules_beside_raw",
    "fill_zero",
    "hash_bucket",
    "hyphens_to_spaces",
    "rejected_counts",
    "safe_ratio",
    "text_to_null",
    "to_double",
    "to_int",
]
