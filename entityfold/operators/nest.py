"""Nest related rows into a base row as an object or an ordered list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VALUE = "__value"
_PAGE = "__page"

# Rows that one page of a list holds, about.
PAGE_ROWS = 100_000


def _object(fields: Mapping[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _sortable(order: Sequence[str], fields: Mapping[str, Column]) -> Column:
    """Sort keys ahead of the value. A flag before each key puts nulls last, as lists want."""
    keys: list[Column] = []
    for at, name in enumerate(order):
        keys += [F.col(name).isNull().alias(f"n{at}"), F.col(name).alias(f"k{at}")]
    return F.struct(*keys, _object(fields).alias(_VALUE))


def nest_one(
    base: DataFrame, dim: DataFrame, on: str, name: str, fields: Mapping[str, Column]
) -> DataFrame:
    """Add ``dim`` (one row per key) as an object; null where there is no row.

    A match whose fields are all null is still an object: presence carries meaning.
    """
    return base.join(dim.select(on, _object(fields).alias(name)), on, "left")


def collect_ordered(
    child: DataFrame, on: str, name: str, fields: Mapping[str, Column], order: Sequence[str]
) -> DataFrame:
    """One row per key with the ordered list of its child objects."""
    return (
        child.where(F.col(on).isNotNull())
        .select(on, _sortable(order, fields).alias(_VALUE))
        .groupBy(on)
        .agg(F.array_sort(F.collect_list(_VALUE)).alias(_VALUE))
        .select(on, F.transform(_VALUE, lambda v: v[_VALUE]).alias(name))
    )


def nest_many(
    base: DataFrame,
    child: DataFrame,
    on: str,
    name: str,
    fields: Mapping[str, Column],
    order: Sequence[str],
) -> DataFrame:
    """Add the ordered list of child objects; an empty list where there is none.

    A list is one value of one row, whatever its length. ``oversized_groups`` reports long
    lists, ``nest_pages`` writes them as rows of bounded size.
    """
    lists = collect_ordered(child, on, name, fields, order)
    empty = F.array().cast(lists.schema[name].dataType)
    return base.join(lists, on, "left").withColumn(name, F.coalesce(F.col(name), empty))


def oversized_groups(child: DataFrame, on: str, limit: int) -> DataFrame:
    """Keys with more child rows than ``limit``, as a report (counted with map-side combine)."""
    return child.where(F.col(on).isNotNull()).groupBy(on).count().where(F.col("count") > limit)


def nest_pages(
    child: DataFrame,
    on: str,
    name: str,
    fields: Mapping[str, Column],
    order: Sequence[str],
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Ordered lists in pages, for keys with too many rows for one list: (key, page, list).

    The rows are counted, then range-partitioned by key and order together into parts of
    about ``page_rows``. A hot key so runs over many parts, and every page is one
    contiguous, ordered slice of one part. Pages of a key, in page order, hold all of its
    rows in order; page numbers have gaps. Rows that are alike in everything are dealt over
    pages by their number in the input, and may stand for one another.
    """
    keyed = child.where(F.col(on).isNotNull())
    parts = max(1, -(-keyed.count() // page_rows))
    ranged = (
        keyed.select(on, _sortable(order, fields).alias(_VALUE))
        .withColumn(_PAGE, F.monotonically_increasing_id())
        .repartitionByRange(parts, on, _VALUE, _PAGE)
        .select(on, F.spark_partition_id().alias(_PAGE), _VALUE)
    )
    return (
        ranged.groupBy(on, _PAGE)
        .agg(F.array_sort(F.collect_list(_VALUE)).alias(_VALUE))
        .select(
            on,
            F.col(_PAGE).alias("page"),
            F.transform(_VALUE, lambda v: v[_VALUE]).alias(name),
        )
    )
