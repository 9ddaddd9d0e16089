"""Numbers: guarded casts, number cells, and money in whole cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityfold.functions.text import WHITE_SPACE, strip_white


def guarded_number(c: Column, kind: str = "decimal(38,6)") -> Column:
    """Plain decimal notation as a number; anything else, exponents included, is null."""
    text = F.trim(c)
    return F.when(text.rlike(r"^-?[0-9]+([.][0-9]+)?\z"), text).cast(kind)


def guarded_integer(c: Column) -> Column:
    """Plain digits, with an optional minus, as a whole number; anything else is null."""
    text = F.trim(c)
    return F.when(text.rlike(r"^-?[0-9]+\z"), text).cast("bigint")


def parsed_number(text: Column) -> Column:
    """A stripped text as a double, exponents allowed; null for anything else.

    Only digits, signs, points and exponents may occur, which keeps out the other forms
    that a cast would take (names of infinities, type suffixes).
    """
    odd = F.translate(text, "0123456789.+-eE", "")
    return F.when(odd == "", text).try_cast("double")


def amount_number(c: Column) -> Column:
    """As ``parsed_number`` of the stripped text, without stripping it when it is plain."""
    return F.coalesce(parsed_number(c), parsed_number(strip_white(c)))


def finite(number: Column) -> Column:
    """Null for a number too large for a double."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def text_number(c: Column) -> Column:
    """A number written as text as a finite double; blank is zero."""
    text = strip_white(c)
    return finite(F.when(text == "", F.lit(0.0)).otherwise(parsed_number(text)))


def clean_number(c: Column) -> Column:
    """A number cell without its thousands commas, dollar signs and spaces; blank is null."""
    plain = F.translate(c, ",$" + WHITE_SPACE, "")
    return F.when(strip_white(c) != "", text_number(plain))


def positive_or_null(number: Column) -> Column:
    """Null unless above zero."""
    return F.when(number > 0, number)


def to_cents(number: Column) -> Column:
    """Dollars as whole cents, halves rounded up (towards plus infinity)."""
    return F.floor(number.cast("double") * 100 + F.lit(0.5)).cast("bigint")


def cents_to_money(cents: Column) -> Column:
    """Whole cents as dollars with two places, exact at every step."""
    return (cents.cast("decimal(30,0)") * F.lit(Decimal("0.01"))).cast("decimal(38,2)")
