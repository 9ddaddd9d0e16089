"""Parquet tables in buckets of their key: joins and rankings on the key then move no rows."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from entityfold.sinks.store import Store

# Says how a folder is bucketed. Spark keeps this in its catalog only, which a folder outlives.
SPEC = "_buckets.json"


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write one file per bucket of the key, sorted by it. Fails when the folder exists.

    Tables that are joined need the same number of buckets, and no fewer than
    ``spark.sql.shuffle.partitions``: below that Spark rather moves the rows. Rows without a key share one bucket,
    so the key should be one that every row has.
    """
    spark, name = rows.sparkSession, f"written_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, key).write.format("parquet").mode("errorifexists")
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    Store(spark, path).write(f"{path}/{SPEC}", json.dumps({"key": key, "buckets": buckets}))


@contextmanager
def buckets_kept(spark: SparkSession) -> Iterator[None]:
    """While plans are made, scans of bucketed tables keep their buckets.

    Spark gives the buckets up when it sees an operator it does not know to profit from them; the
    early row limit of a ranking is one, although the ranking above it does.
    """
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet folder with its buckets, if it has any; of a missing folder the reader's own error."""
    store = Store(spark, path)
    spec = store.read(f"{path}/{SPEC}")
    if spec is None:
        return spark.read.schema(schema).parquet(path)
    fields = spark.createDataFrame([], schema).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    known = json.loads(spec)
    key, buckets = known["key"], known["buckets"]
    same = f"{path} {store.changed(path)} {spec} {columns}"
    name = f"bucketed_{hashlib.md5(same.encode()).hexdigest()}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
