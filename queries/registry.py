"""The list of queries: a function of (session, data folder), and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")
