"""Checks over finished documents: rules, uniqueness, order, coverage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def failing_rules(rules: Mapping[str, Column]) -> Column:
    """The names of the rules a row does not meet. A rule that is null is not met."""
    return F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).cast("string")
                for name, ok in rules.items()
            ]
        )
    )


def check_documents(doc: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """(key, rule): one row per rule that a document does not meet."""
    return doc.select(key, F.explode(failing_rules(rules)).alias("rule"))


def rule_counts(issues: DataFrame) -> DataFrame:
    """(rule, issues)."""
    return issues.groupBy("rule").agg(F.count(F.lit(1)).alias("issues"))


def top_issues(issues: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first ``n`` issues by key and rule, for a report."""
    return issues.orderBy(key, "rule").limit(n)


def check_unique(doc: DataFrame, key: str) -> DataFrame:
    """(key, copies): keys that more than one document carries."""
    return (
        doc.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def order_breaks(
    rows: DataFrame, file: str, position: str, key: str, block: int = 65_536
) -> DataFrame:
    """(file, position, key, previous): rows whose key is null or not above the one before.

    ``position`` counts the rows of a file without gaps. Neighbours are compared inside
    blocks of positions, so a large file runs over many tasks; the first row of each
    block is then compared with the last row of the block before, one row per block.
    """
    seq = rows.select(file, position, key).withColumn(
        "__block", F.floor(F.col(position) / block).cast("bigint")
    )
    within = Window.partitionBy(file, "__block").orderBy(position)
    pairs = seq.withColumn("previous", F.lag(key).over(within)).withColumn(
        "__first", F.row_number().over(within) == 1
    )
    # A null key is out of order wherever it stands.
    inside = pairs.where(
        F.col(key).isNull() | (~F.col("__first") & (F.col(key) <= F.col("previous")))
    )

    ends = seq.groupBy(file, "__block").agg(
        F.min_by(F.struct(position, key), position).alias("__head"),
        F.max_by(key, position).alias("previous"),
    )
    heads = ends.select(file, "__block", "__head.*")
    tails = ends.select(file, (F.col("__block") + 1).alias("__block"), "previous")
    between = heads.join(tails, [file, "__block"]).where(F.col(key) <= F.col("previous"))

    names = [file, position, key, "previous"]
    return inside.select(names).unionByName(between.select(names))


def coverage(doc: DataFrame, counters: Mapping[str, Column]) -> DataFrame:
    """One row: ``total`` and, per counter, the documents that meet it. One pass."""
    return doc.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(n) for n, c in counters.items()]
    )


def count_on_the_way(doc: DataFrame, counters: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The documents as they are, and the counts of ``coverage`` over them, which whatever first runs
    over them gathers: a write then needs no pass of its own for its checks."""
    seen = Observation()
    counts = [F.count_if(c).alias(n) for n, c in counters.items()]
    return doc.observe(seen, F.count(F.lit(1)).alias("total"), *counts), seen


def _long(cov: DataFrame) -> DataFrame:
    names = [c for c in cov.columns if c != "total"]
    return cov.unpivot(["total"], names, "name", "got")


def percent_coverage(cov: DataFrame) -> DataFrame:
    """(name, got, percent) with one decimal; 0.0 when there are no documents."""
    share = F.round(F.lit(100).cast("double") * F.col("got") / F.nullif("total", F.lit(0)), 1)
    return _long(cov).select("name", "got", F.coalesce(share, F.lit(0.0)).alias("percent"))


def coverage_shortfalls(cov: DataFrame, floors: DataFrame) -> DataFrame:
    """(name, got, required): the counters below their floor. ``floors`` is (name, floor)."""
    return (
        floors.join(_long(cov), "name")
        .where(F.col("got") < F.col("floor"))
        .select("name", "got", F.col("floor").cast("bigint").alias("required"))
    )
