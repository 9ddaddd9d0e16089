"""Money aggregates: contract releases per supplier, grant awards per recipient.

Money is summed in whole cents, so totals do not depend on the order of the rows.
All aggregates combine on the map side first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityfold.functions import first_ten, to_cents
from entityfold.functions.keys import quick_digits
from entityfold.functions.numbers import amount_number, finite
from entityfold.operators.relate import first_seen


def _party_keys(scheme: str, role: str, n_digits: int) -> Column:
    """The distinct n-digit keys of the parties with this role, first or additional identifiers."""

    with_role = F.filter(
        "parties", lambda p: F.coalesce(F.array_contains(p["roles"], role), F.lit(False))
    )
    # A field of an array of structs is the array of that field, without a function per element.
    extra = F.flatten(F.array_compact(with_role["additionalIdentifiers"]))
    ids = F.concat(with_role["identifier"], extra)
    keys = F.transform(ids, lambda i: F.when(i["scheme"] == scheme, quick_digits(i["id"])))
    right_size = F.filter(keys, lambda k: F.length(k) == n_digits)
    return F.coalesce(F.array_distinct(right_size), F.array().cast("array<string>"))


def extract_releases(
    releases: DataFrame,
    position: Sequence[str],
    scheme: str = "AU-ABN",
    role: str = "supplier",
    n_digits: int = 11,
) -> DataFrame:
    """(ocid, position.., suppliers, cents, signed) of each contract release.

    ``cents`` sums all contracts of the release; ``signed`` is the earliest signing
    date. Narrow on purpose: this is what the de-duplication shuffles.
    """
    # One step per transform: inside a lambda Spark evaluates a repeated part again. Amounts
    # are nearly always plain, so white space is looked for only where the plain form fails.
    amounts = F.coalesce("contracts.value.amount", F.array().cast("array<string>"))
    numbers = F.transform(amounts, amount_number)
    zero = F.lit(0).cast("bigint")
    cents = F.aggregate(
        numbers, zero, lambda total, n: total + F.coalesce(to_cents(finite(n)), zero)
    )
    signed = F.array_min(F.transform("contracts.dateSigned", first_ten))
    return releases.select(
        "ocid",
        *position,
        _party_keys(scheme, role, n_digits).alias("suppliers"),
        cents.alias("cents"),
        signed.alias("signed"),
    )


def distinct_releases(extracted: DataFrame, position: Sequence[str]) -> DataFrame:
    """Each release once: the first seen of an ocid; releases without one are all kept."""
    return first_seen(extracted, "ocid", position)


def spend_by_supplier(distinct: DataFrame) -> DataFrame:
    """(supplier, cents, releases, first_signed, last_signed).

    Every supplier of a release gets its full value. First and last both look at the
    release's earliest signing date.
    """
    return (
        distinct.select(F.explode("suppliers").alias("supplier"), "cents", "signed")
        .groupBy("supplier")
        .agg(
            F.sum("cents").alias("cents"),
            F.count(F.lit(1)).alias("releases"),
            F.min("signed").alias("first_signed"),
            F.max("signed").alias("last_signed"),
        )
    )


def awards_by_recipient(awards: DataFrame) -> DataFrame:
    """(recipient, cents, awards, first_published, last_published); keyless awards are left out."""
    return (
        awards.where(F.col("recipient").isNotNull() & F.col("cents").isNotNull())
        .groupBy("recipient")
        .agg(
            F.sum("cents").alias("cents"),
            F.count(F.lit(1)).alias("awards"),
            F.min("published").alias("first_published"),
            F.max("published").alias("last_published"),
        )
    )


def ingest_stats(
    df: DataFrame, counters: Mapping[str, Column], distinct: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row: ``rows``, one count per condition, and one distinct count per column."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(c).alias(n) for n, c in counters.items()],
        *[F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()],
    )
