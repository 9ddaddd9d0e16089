"""Counts per bucket, build against build, counts against shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityfold.functions import bucket_key


def bucket_counts(doc: DataFrame, key: str, name: str = "bucket") -> DataFrame:
    """(bucket, n): documents per bucket, blank and null in ``other``."""
    return doc.groupBy(bucket_key(F.col(key)).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def with_total(counts: DataFrame, name: str = "bucket", total: str = "total") -> DataFrame:
    """The counts and one more row with their sum."""
    row = counts.agg(F.lit(total).alias(name), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return counts.select(name, "n").unionByName(row)


def shard_total(shards: DataFrame) -> DataFrame:
    """One row: the records of all shards that are not themselves bundles of shards."""
    own = F.when(~F.col("aggregate"), F.col("records"))
    return shards.agg(F.coalesce(F.sum(own), F.lit(0)).cast("bigint").alias("total"))


def compare_counts(
    current: DataFrame, prior: DataFrame, key: str, threshold: float
) -> DataFrame:
    """(key, prior, current, change, status) for two builds.

    ``change`` is a fraction of the prior count. Status: ``appeared`` (none before),
    ``retired`` (none now), ``moved`` (beyond the threshold, up or down), else ``ok``.
    """
    now, before = F.coalesce("current", F.lit(0)), F.coalesce("prior", F.lit(0))
    change = (now - before) / F.nullif(before, F.lit(0))
    status: Column = (
        F.when((before == 0) & (now > 0), "appeared")
        .when((before > 0) & (now == 0), "retired")
        .when(F.abs(change) > threshold, "moved")
        .otherwise("ok")
    )
    return (
        current.select(key, F.col("n").alias("current"))
        .join(prior.select(key, F.col("n").alias("prior")), key, "full")
        .select(
            key,
            before.cast("bigint").alias("prior"),
            now.cast("bigint").alias("current"),
            change.alias("change"),
            status.alias("status"),
        )
    )


def reconcile(counts: DataFrame, shards: DataFrame, key: str) -> DataFrame:
    """(key, problem): buckets and shards that do not agree, in both directions.

    ``counts`` is (key, n), ``shards`` is (key, records) with any number of parts per
    key. An empty bucket may go without a shard.
    """
    held = shards.groupBy(key).agg(F.sum("records").alias("records"))
    problem: Column = (
        F.when(F.col("n").isNull(), "shard without a count")
        .when(F.col("records").isNull() & (F.col("n") > 0), "count without a shard")
        .when(F.col("records") != F.col("n"), "counts differ")
    )
    return (
        counts.select(key, "n")
        .join(held, key, "full")
        .select(key, problem.alias("problem"))
        .where(F.col("problem").isNotNull())
    )


def unattributed_sources(sources: DataFrame, attributions: DataFrame, on: str = "name") -> DataFrame:
    """Sources that no attribution line names."""
    return sources.join(attributions, on, "left_anti")
