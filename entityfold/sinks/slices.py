"""Shards and bundle from one layout: the lines of a release, sorted by id and cut into ranges once.

The lines are written as a table whose files are consecutive ranges of ids. Shards and bundle are
both made from it slice by slice, without another shuffle: a slice is what one task reads of one
file, and its name says where it stands. Files are cut by bytes, so that none is longer than a hash
can hold in memory.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityfold.functions import bucket_key
from entityfold.operators.compare import shard_total
from entityfold.operators.gates import GateError
from entityfold.sinks.shards import _hashed, json_line

# The functions that run on batches travel to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Most bytes of text in one file, before compression. A longer line has a file of its own.
FILE_BYTES = 256 * 1024 * 1024


def write_ordered_lines(
    doc: DataFrame, path: str, key: str, id_column: str = "_id", ranges: int | None = None
) -> None:
    """Documents as (id, bucket, value), in files that are consecutive ranges of ids, each sorted.

    The only shuffle of a release. ``ranges`` is the number of files; Spark decides without it.
    """
    ranged = doc.repartitionByRange(ranges, id_column) if ranges else doc.repartitionByRange(id_column)
    lines = ranged.sortWithinPartitions(id_column).select(
        F.col(id_column).alias("id"), bucket_key(F.col(key)).alias("bucket"), json_line(doc).alias("value")
    )
    lines.write.mode("errorifexists").parquet(path)


def sliced_lines(spark: SparkSession, path: str) -> DataFrame:
    """(slice, id, bucket, value): ``slice`` sorts as the ids do."""
    number = F.regexp_extract("_metadata.file_path", r"part-(\d+)-", 1)
    place = F.lpad(F.col("_metadata.file_block_start").cast("string"), 13, "0")
    lines = spark.read.schema("id string, bucket string, value string").parquet(path)
    return lines.select(F.concat_ws("-", number, place).alias("slice"), "id", "bucket", "value")


def _cutter(max_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds a piece number to rows (first, second, id, value): a new one at ``max_bytes`` or another
    (first, second)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, piece, held = None, 0, 0
        for batch in batches:
            first, second, ids, value = batch.columns
            size = pc.add(pc.binary_length(value.cast(pa.binary())), 1).to_pylist()
            pieces = []
            for group, n in zip(zip(first.to_pylist(), second.to_pylist(), strict=True), size, strict=True):
                if group != at:
                    at, piece, held = group, 0, 0
                elif held + n > max_bytes:
                    piece, held = piece + 1, 0
                held += n
                pieces.append(f"{piece:05d}")
            yield pa.RecordBatch.from_arrays([first, second, ids, value, pa.array(pieces, pa.string())], ["first", "second", "id", "value", "piece"])

    return cut


def _cut(lines: DataFrame, first: str, second: str, max_bytes: int) -> DataFrame:
    rows = lines.select(F.col(first).alias("first"), F.col(second).alias("second"), "id", "value")
    rows = rows.sortWithinPartitions("first", "second", "id")
    return rows.mapInArrow(_cutter(max_bytes), "first string, second string, id string, value string, piece string")


def line_shards(lines: DataFrame, max_bytes: int = FILE_BYTES) -> DataFrame:
    """(bucket, part, value) in the order in which the shards hold them; no shuffle."""
    cut = _cut(lines, "bucket", "slice", max_bytes)
    part = F.concat_ws("-", "second", "piece")
    ordered = cut.select(F.col("first").alias("bucket"), part.alias("part"), "id", "value")
    return ordered.sortWithinPartitions("bucket", "part", "id").select("bucket", "part", "value")


def write_line_shards(spark: SparkSession, lines: str, path: str, max_bytes: int = FILE_BYTES) -> None:
    """Gzipped JSON lines under ``bucket=<key>/part=<place>/``: ordered by id inside a file, and the files
    of a bucket by their names."""
    shards = line_shards(sliced_lines(spark, lines), max_bytes)
    shards.write.mode("errorifexists").partitionBy("bucket", "part").option("compression", "gzip").text(path)


def line_bundle(lines: DataFrame, max_bytes: int = FILE_BYTES) -> DataFrame:
    """(part, value) in the order of the ids; no shuffle."""
    cut = _cut(lines.withColumn("all", F.lit("")), "slice", "all", max_bytes)
    ordered = cut.select(F.concat_ws("-", "first", "piece").alias("part"), "id", "value")
    return ordered.sortWithinPartitions("part", "id").select("part", "value")


def write_line_bundle(
    spark: SparkSession, lines: str, out: str, manifest: DataFrame, max_bytes: int = FILE_BYTES
) -> DataFrame:
    """All lines in one order of ids under ``part=<place>/``; the manifest with these files added.

    Read by their names one after the other, the files are the whole release in order. They repeat
    the shards, so they are marked ``aggregate`` and left out of the total. Fails when the bundle
    does not hold exactly the records of the shards.
    """
    bundle = line_bundle(sliced_lines(spark, lines), max_bytes)
    bundle.write.mode("errorifexists").partitionBy("part").option("compression", "gzip").text(out)
    below = F.regexp_extract("shard", "(part=.*)$", 1)
    held = spark.read.schema("value string").option("basePath", out).text(out)
    records = held.select(F.col("_metadata.file_path").alias("shard")).groupBy(below.alias("shard"))
    files = _hashed(spark, out).withColumn("shard", below)
    files = files.join(records.agg(F.count(F.lit(1)).alias("records")), "shard")
    files = files.select("shard", F.lit("all").alias("bucket"), "records", "bytes", "sha256")
    own, other = F.lit(False).alias("aggregate"), F.lit(True).alias("aggregate")
    both = manifest.select("*", own).unionByName(files.select("*", other))
    total = shard_total(both).first()["total"]
    found = files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    if found != total:
        raise GateError(f"the bundle holds {found} records, the shards {total}")
    return both
