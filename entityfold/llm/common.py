"""Shared helpers: tables in the shared folder, slices of Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from entityfold.session import fresh_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` made and nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(key: str | Column, parts: int) -> Column:
    """CRC-32 of a key written as text, modulo ``parts``; null for a null key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % F.lit(parts)


def bounded_sample(df: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, or all if there are fewer, and ``_share``, the
    part of the label's rows that was taken.

    The rows of least key hash are taken, so the bound holds to within chance. ``label`` is a
    class with few values; rows with a null label or key are left out.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    shares = {r[0]: min(1.0, per_label / r[1]) for r in rows.groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, part in sorted(shares.items()):
        share = F.when(F.col(label) == F.lit(value), F.lit(part)).otherwise(share)
    place = F.xxhash64(F.col(key).cast("string"), F.lit("sample")).cast("double") / 2.0**64 + 0.5
    return rows.withColumn("_share", share).where(place <= F.col("_share"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small pieces of batches, so that what Python holds at once stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    rows: int = 256,
) -> DataFrame:
    """``mapInArrow`` over small slices; ``make`` runs once per task and returns the function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for piece in slices(batches, rows):
            yield work(piece)

    return df.mapInArrow(run, schema)


def add_columns(
    df: DataFrame,
    keep: tuple[str, ...],
    sources: tuple[str, ...],
    added: str,
    make: Callable[[], Callable[..., list]],
    rows: int = 256,
) -> DataFrame:
    """The columns ``keep`` and new ones computed in Python from the columns ``sources``.

    ``make`` runs once per task; the function it returns takes a list of values per source and
    gives a list or array of values per column of ``added`` (DDL). A source that is also kept is
    sent once.
    """
    extra = [s for s in sources if s not in keep]
    taken = df.select(*(df[c] for c in keep), *(df[c].alias(f"_source{i}") for i, c in enumerate(extra)))
    place = [keep.index(s) if s in keep else len(keep) + extra.index(s) for s in sources]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), added])
    arrow = to_arrow_schema(_parse_datatype_string(added))

    def prepare() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        work = make()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = work(*(batch.column(i).to_pylist() for i in place))
            new = [pa.array(v, t) for v, t in zip(found, arrow.types, strict=True)]
            return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], [*keep, *arrow.names])

        return run

    return map_batches(taken, prepare, fields, rows)


def least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of 0 to n-1 the least number it reaches by links a-b; for what one task holds."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        new = root.copy()
        for ends in (a, b, root[a], root[b]):
            np.minimum.at(new, ends, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Label every node of an undirected graph with the smallest node it can reach.

    Alternates the two star steps: each node links its larger neighbours to its smallest one,
    then its smaller ones. The steps are joins and minima, so no neighbourhood is gathered in
    one task. Each round is a table in the shared folder; the number of rounds grows with the
    logarithm of the longest path. Nodes
    without an edge to another node, and edges with a null end, are left out.

    Returns ``node``, ``component``.
    """

    def star(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("u"), F.col("v")).union(pairs.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        return small.union(low.select("u", F.col("m").alias("v"))).distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(
            pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )

    ends = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    ends = ends.where(F.col("u") > F.col("v")).distinct()
    pairs = materialise(ends, "edges")
    seen = mark(pairs)
    while True:
        further = materialise(star(pairs), "edges")
        found = mark(further)
        discard(pairs)
        pairs = further
        if found == seen:
            break
        seen = found
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(pairs.select("v", "v").distinct())
