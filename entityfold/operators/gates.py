"""Gates: conditions a load must meet, as reports and as errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A load or a build is not fit to be used."""


def require_empty(bad: DataFrame, message: str, show: int = 5) -> None:
    """Fail with a few example rows when ``bad`` is not empty."""
    rows = bad.take(show)
    if rows:
        raise GateError(f"{message}: " + "; ".join(str(r.asDict()) for r in rows))


def gate_floors(counts: DataFrame, floors: DataFrame) -> DataFrame:
    """(source, n, floor, ok): rows loaded against the least each source must give.

    A source with a floor and no count has loaded nothing.
    """
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return (
        floors.select("source", F.col("floor").cast("bigint").alias("floor"))
        .join(counts.select("source", "n"), "source", "left")
        .select("source", n.alias("n"), "floor", (n >= F.col("floor")).alias("ok"))
    )


def flag_capped_chunks(df: DataFrame, chunk: str | Column, cap: int) -> DataFrame:
    """(chunk, n, capped): report chunks with as many rows as the report can hold.

    Count every row of the report, keyless rows included; a full report is cut off.
    """
    return (
        df.groupBy((F.col(chunk) if isinstance(chunk, str) else chunk).alias("chunk"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("capped", F.col("n") >= cap)
    )


def fanout_report(base: DataFrame, out: DataFrame, key: str) -> DataFrame:
    """One row: base_rows, out_rows, out_keys. All three are equal when no join multiplied rows."""
    names = ["base_rows", "out_rows", "out_keys"]
    zero = F.lit(0).cast("bigint")
    before = base.agg(F.count(F.lit(1)).alias(names[0]))
    after = (
        out.groupBy(key)
        .count()
        .agg(F.sum("count").alias(names[1]), F.count(F.lit(1)).alias(names[2]))
    )
    both = before.unionByName(after, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.max(n), zero).alias(n) for n in names])


def assert_no_fanout(base: DataFrame, out: DataFrame, key: str) -> None:
    """Fail when a join changed the number of rows or repeated a key."""
    row = fanout_report(base, out, key).first()
    if not row["base_rows"] == row["out_rows"] == row["out_keys"]:
        raise GateError(f"rows were multiplied or lost: {row.asDict()}")


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Fail when a key is null or repeated; return the table."""
    keys = [key] if isinstance(key, str) else list(key)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    counted = df.groupBy(*keys).count()
    require_empty(counted.where(missing | (F.col("count") > 1)), "null or repeated key")
    return df
