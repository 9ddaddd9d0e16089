"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a hash of the key. A bucket that holds more
than the byte limit, and more than one hash value, splits on one more bit; all others stay as
they are. Bytes are summed per cell of a directory a few bits deeper than the average shard
needs, buckets of all depths are sums of cells, and only cells that are still too large go into
another round with more bits.

A bucket whose rows all have one hash value cannot be split by bits. If it is too large, its
rows are cut into parts by running size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityfold.llm.common import materialise

HASH_BITS = 60
SPARE_BITS = 3
MOST_BITS = 24


def key_hash(key: Column) -> Column:
    """The leading 60 bits of the MD5 of the key as text; a null key is an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _directory(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """For each cell of ``high`` bits its bucket: ``depth`` (``high + 1``: still too large),
    ``bytes``, ``n_rows`` and ``largest`` of the bucket. Depths start at ``low``."""
    cell = F.shiftright("h", HASH_BITS - high).alias("cell")
    sums = (F.sum("bytes"), F.min("least"), F.max("most"), F.sum("n_rows"), F.max("largest"))
    names = ("bytes", "least", "most", "n_rows", "largest")
    cells = rows.groupBy(cell).agg(
        F.sum("bytes").alias("bytes"), F.min("h").alias("least"), F.max("h").alias("most"),
        F.count("*").alias("n_rows"), F.max("bytes").alias("largest"),
    )
    cells = materialise(cells, "cells")
    depth = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("d")
    of = cells.select("*", depth).withColumn("prefix", F.expr(f"shiftright(cell, {high} - d)"))
    buckets = of.groupBy("d", "prefix").agg(*(s.alias(n) for s, n in zip(sums, names, strict=True)))
    buckets = buckets.withColumn("splits", (F.col("bytes") > limit) & (F.col("least") < F.col("most")))
    buckets = materialise(buckets, "buckets")
    path = of.select("cell", "d", "prefix").join(buckets.select("d", "prefix", "splits"), ["d", "prefix"])
    depths = path.groupBy("cell").agg((F.lit(low) + F.sum(F.col("splits").cast("int"))).cast("int").alias("depth"))
    depths = depths.withColumn("prefix", F.expr(f"shiftright(cell, greatest({high} - depth, 0))"))
    leaves = buckets.select(F.col("d").alias("depth"), "prefix", F.col("bytes").alias("shard_bytes"), "n_rows", "largest")
    return materialise(depths.join(leaves, ["depth", "prefix"], "left").drop("prefix"), "directory")


def assign_shards(df: DataFrame, limit: int, key: str = "doc_id", size: str = "n_bytes") -> DataFrame:
    """Add ``shard`` (the bits of the bucket, empty if all fits), ``depth``, ``part`` and ``shard_bytes``.

    ``size`` holds the bytes of a row (null: none). ``shard`` and ``part`` name a file;
    ``shard_bytes`` is the size of all parts of the bucket. ``part`` is 0 but in a bucket of a
    single hash value that is over ``limit``: its rows are cut into parts that fit, one that is
    alone over ``limit`` has a part of its own. Null keys are one key; repeated rows are rows of
    their own. ``df`` is read several times and should be a written table; it must not have
    columns of the four new names.
    """
    pending = df.select(
        F.struct(*(df[c] for c in df.columns)).alias("row"),
        key_hash(F.col(key)).alias("h"),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("bytes"),
    )
    total = pending.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(MOST_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
    done = []
    while True:
        directory = _directory(pending.select("h", "bytes"), low, high, limit)
        found = pending.withColumn("cell", F.shiftright("h", HASH_BITS - high)).join(directory, "cell").drop("cell")
        done.append(found.where(F.col("depth") <= high))
        if high == HASH_BITS or directory.where(F.col("depth") > high).isEmpty():
            break
        pending = found.where(F.col("depth") > high).select("row", "h", "bytes")
        low, high = high + 1, min(HASH_BITS, high + 8)
    placed = done[0]
    for more in done[1:]:
        placed = placed.union(more)
    bits = F.lpad(F.conv(F.col("h").cast("string"), 10, 2), HASH_BITS, "0")
    placed = placed.withColumn("shard", F.substring(bits, F.lit(1), F.col("depth")))
    whole = (F.col("shard_bytes") <= limit) | (F.col("n_rows") == 1)
    out = ["row.*", "shard", "depth", "part", "shard_bytes"]
    if placed.where(~whole).isEmpty():
        return placed.withColumn("part", F.lit(0).cast("long")).select(out)
    hot = materialise(placed.where(~whole), "hot")
    hot = hot.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = hot.groupBy("h", "file").agg(F.sum("bytes").alias("all"))
    files = files.withColumn("before", F.sum("all").over(Window.partitionBy("h").orderBy("file")) - F.col("all")).drop("all")
    running = F.sum("bytes").over(Window.partitionBy("h", "file").orderBy("at")) - F.col("bytes")
    room = F.greatest(F.lit(limit) - F.col("largest") + 1, F.lit(1))
    cut = hot.withColumn("within", running).join(files, ["h", "file"])
    cut = cut.withColumn("part", F.floor((F.col("before") + F.col("within")) / room).cast("long"))
    return placed.where(whole).withColumn("part", F.lit(0).cast("long")).select(out).union(cut.select(out))


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write one folder per shard and part below ``path``, which must not exist."""
    named = assigned.withColumn("shard_file", F.concat_ws("-", F.lit("s"), "shard", "part"))
    named.repartition("shard", "part").write.partitionBy("shard_file").parquet(path)
