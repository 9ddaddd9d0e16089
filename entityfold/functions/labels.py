"""Codes and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityfold.functions.text import stripped, trimmed


def expand_code(c: Column, names: Mapping[str, str]) -> Column:
    """Known codes (any case) written out; every other code as it is."""
    code = trimmed(c)
    known = [F.when(F.upper(code) == k, F.lit(v)) for k, v in names.items()]
    return F.coalesce(*known, code)


def first_true_label(flags: Sequence[tuple[Column, str]], yes: str = "Y") -> Column:
    """The label of the first flag, in the order given, that says yes."""
    return F.coalesce(*[F.when(flag == yes, F.lit(label)) for flag, label in flags])


def bucket_key(c: Column, other: str = "other") -> Column:
    """A lower-case bucket name; null and blank go to ``other``."""
    return F.coalesce(F.lower(stripped(c)), F.lit(other))
