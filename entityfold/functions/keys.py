"""Entity keys: digit cleaning, routing by digit count, and the check digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights and modulus of the 11-digit business number.
ABN_WEIGHTS = (10, 1, 3, 5, 7, 9, 11, 13, 15, 17, 19)
ABN_MODULUS = 89

ABN_DIGITS = 11
ACN_DIGITS = 9


def digits(c: Column) -> Column:
    """Only the digits of a text."""
    return F.regexp_replace(c, r"[^0-9]", "")


def quick_digits(c: Column) -> Column:
    """As ``digits``, without the regular expression for a text that is digits already."""
    return F.when(F.translate(c, "0123456789", "") == "", c).otherwise(digits(c))


def has_digits(c: Column, n: int) -> Column:
    """True when the text is exactly ``n`` digits."""
    return c.rlike(rf"^[0-9]{{{n}}}\z")


def routed(c: Column) -> tuple[Column, Column]:
    """A mixed column as (11-digit key, 9-digit key); the one that does not fit is null."""
    d = digits(c)
    return (
        F.when(F.length(d) == ABN_DIGITS, d),
        F.when(F.length(d) == ACN_DIGITS, d),
    )


def routed_padded(c: Column) -> tuple[Column, Column]:
    """As ``routed``, for cells whose 9-digit key lost its leading zeros (6 to 9 digits left)."""
    d = digits(c)
    return (
        F.when(F.length(d) == ABN_DIGITS, d),
        F.when(F.length(d).between(6, ACN_DIGITS), F.lpad(d, ACN_DIGITS, "0")),
    )


def abn_valid(c: Column) -> Column:
    """True when the 11-digit key passes its weighted checksum; false for anything else.

    Plain arithmetic on character codes, so that it stays inside generated code.
    """
    total = F.lit(-ABN_WEIGHTS[0])  # one is taken off the first digit
    for at, weight in enumerate(ABN_WEIGHTS, start=1):
        total = total + (F.ascii(F.substring(c, at, 1)) - F.lit(48)) * F.lit(weight)
    return F.coalesce(has_digits(c, ABN_DIGITS) & (total % ABN_MODULUS == 0), F.lit(False))
