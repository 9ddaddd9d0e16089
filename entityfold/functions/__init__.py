"""Scalar column functions. All are expressions of built-in functions, no Python runs per row."""

from entityfold.functions.dates import (
    age_years,
    compact_date,
    compact_iso,
    first_ten,
    guarded_date,
    iso,
    sheet_date,
    strict_date,
)
from entityfold.functions.keys import abn_valid, digits, has_digits, routed, routed_padded
from entityfold.functions.labels import bucket_key, expand_code, first_true_label
from entityfold.functions.numbers import (
    cents_to_money,
    clean_number,
    guarded_integer,
    guarded_number,
    positive_or_null,
    text_number,
    to_cents,
)
from entityfold.functions.text import joined, safe_name, safe_name_column, stripped, trimmed

__all__ = [
    "abn_valid",
    "age_years",
    "bucket_key",
    "cents_to_money",
    "clean_number",
    "compact_date",
    "compact_iso",
    "digits",
    "expand_code",
    "first_ten",
    "first_true_label",
    "guarded_date",
    "guarded_integer",
    "guarded_number",
    "has_digits",
    "iso",
    "joined",
    "positive_or_null",
    "routed",
    "routed_padded",
    "safe_name",
    "safe_name_column",
    "sheet_date",
    "strict_date",
    "stripped",
    "text_number",
    "to_cents",
    "trimmed",
]
