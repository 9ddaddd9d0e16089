"""Choose the file of a source among its listed snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_listing(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, name, size, pos) of the files in a landing folder; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    ).select("path", "length")
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("path").alias("pos"),
    )


def year_in(c: Column) -> Column:
    """The first whole four-digit word of a text as a year, or -1."""
    found = F.regexp_extract(c, r"\b([0-9]{4})\b", 1)
    return F.coalesce(F.nullif(found, F.lit("")).cast("int"), F.lit(-1))


def income_year_in(c: Column) -> Column:
    """The first year of an income year such as 2023-24, or -1."""
    found = F.regexp_extract(c, r"([0-9]{4})-[0-9]{2}", 1)
    return F.coalesce(F.nullif(found, F.lit("")).cast("int"), F.lit(-1))


def pick_snapshot(
    listing: DataFrame, partition: str, match: Column, order: Sequence[Column]
) -> DataFrame:
    """The first matching file of each source in the given order (which must be total).

    Largest file: ``[size desc, pos]``. Latest year: ``[year desc, size desc, pos]``.
    """
    window = Window.partitionBy(partition).orderBy(*order)
    return (
        listing.where(match)
        .withColumn("__rank", F.row_number().over(window))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )
