"""Documents as JSON lines, split into ordered, compressed shards with a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityfold.functions import bucket_key
from entityfold.operators.compare import reconcile, shard_total
from entityfold.operators.gates import GateError, require_empty
from entityfold.operators.verify import order_breaks

_LINE = "value"

# Most documents in one shard file: keeps a file small enough to be hashed in memory.
SHARD_RECORDS = 1_000_000


def _plain_numbers(c: Column, kind: T.DataType) -> Column:
    """Decimals as numbers without trailing zeros, at any depth; everything else as it is."""
    if isinstance(kind, T.DecimalType):
        return F.parse_json(c.cast("string"))
    if isinstance(kind, T.StructType):
        inner = [_plain_numbers(c[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(c.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _plain_numbers(x, kind.elementType))
    return c


def json_line(doc: DataFrame) -> Column:
    """A whole row as JSON text: fields in order, nulls written out."""
    fields = [_plain_numbers(F.col(f.name), f.dataType).alias(f.name) for f in doc.schema]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def write_ndjson(doc: DataFrame, path: str, id_column: str = "_id") -> None:
    """One JSON line per document, in order of the id over all files. Fails when it exists."""
    doc.orderBy(id_column).select(json_line(doc).alias(_LINE)).write.mode("errorifexists").text(
        path
    )


def write_shards(
    doc: DataFrame,
    path: str,
    key: str,
    id_column: str = "_id",
    shards: int | None = None,
    max_records: int = SHARD_RECORDS,
) -> None:
    """Gzipped JSON lines under ``bucket=<key>/``, ordered by id inside a bucket.

    Rows are range-partitioned by bucket and id together, so a bucket with a third of
    all documents becomes many files, each a contiguous range of ids.
    """
    keyed = doc.withColumn("__bucket", bucket_key(F.col(key)))
    by = ["__bucket", id_column]
    ranged = keyed.repartitionByRange(shards, *by) if shards else keyed.repartitionByRange(*by)
    # The text is made after the shuffle: the pass that samples the ranges need not make it.
    (
        ranged.sortWithinPartitions(*by)
        .select(F.col("__bucket").alias("bucket"), json_line(doc).alias(_LINE))
        .write.mode("errorifexists")
        .partitionBy("bucket")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .text(path)
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(shard, bucket, value): the lines of all shards."""
    return (
        spark.read.schema("value string, bucket string")
        .option("basePath", path)
        .text(path)
        .select(F.col("_metadata.file_path").alias("shard"), "bucket", _LINE)
    )


def shard_order_breaks(spark: SparkSession, path: str, id_column: str = "_id") -> DataFrame:
    """(shard, position, id, previous): lines whose id is not above that of the line before.

    A compressed shard is read by one task, so row numbers run through it without gaps.
    """
    lines = read_shards(spark, path).select(
        "shard",
        F.monotonically_increasing_id().alias("position"),
        F.get_json_object(_LINE, f"$.{id_column}").alias("id"),
    )
    return order_breaks(lines, "shard", "position", "id")


def merge_shards(spark: SparkSession, path: str, id_column: str = "_id") -> DataFrame:
    """The lines of all shards in one order of ids, over all buckets."""
    id_text = F.get_json_object(_LINE, f"$.{id_column}")
    return read_shards(spark, path).select(id_text.alias(id_column), _LINE).orderBy(id_column)


def _below(path: Column) -> Column:
    """The part of a shard's path below the output folder."""
    return F.regexp_extract(path, "(bucket=.*)$", 1)


def _hashed(spark: SparkSession, path: str) -> DataFrame:
    """(shard, bytes, sha256) of the compressed files below a folder."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.gz")
        .load(path)
        .select(
            F.col("path").alias("shard"),
            F.col("length").alias("bytes"),
            F.sha2("content", 256).alias("sha256"),
        )
    )


def build_manifest(spark: SparkSession, path: str, counts: DataFrame) -> DataFrame:
    """(shard, bucket, records, bytes, sha256) of every shard file, checked against the counts.

    ``counts`` is (bucket, n). Fails when shards and counts do not agree both ways.
    """
    files = _hashed(spark, path)
    if files.isEmpty():
        raise GateError(f"no shards in {path}")
    files = files.withColumn("shard", _below(F.col("shard")))
    # The other reader names files by URI; undo its encoding to meet on the same name.
    uri = F.url_decode(F.replace(F.col("shard"), F.lit("+"), F.lit("%2B")))
    records = (
        read_shards(spark, path)
        .groupBy(_below(uri).alias("shard"), "bucket")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    manifest = files.join(records, "shard", "left").select(
        "shard",
        "bucket",
        F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
        "bytes",
        "sha256",
    )
    require_empty(reconcile(counts, manifest, "bucket"), "shards and counts do not agree")
    return manifest


def write_bundle(
    spark: SparkSession,
    path: str,
    out: str,
    manifest: DataFrame,
    id_column: str = "_id",
    max_records: int = SHARD_RECORDS,
) -> DataFrame:
    """All shards merged in one order of ids; the manifest with the bundle's files added.

    The bundle repeats the shards, so its files are marked ``aggregate`` and left out of
    the total. Fails when the bundle does not hold exactly the records of the shards.
    """
    merged = merge_shards(spark, path, id_column).select(_LINE)
    writer = merged.write.mode("errorifexists").option("compression", "gzip")
    writer.option("maxRecordsPerFile", max_records).text(out)
    records = (
        spark.read.text(out)
        .groupBy(_name(F.col("_metadata.file_path")).alias("shard"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    bundle = (
        _hashed(spark, out)
        .withColumn("shard", _name(F.col("shard")))
        .join(records, "shard")
        .select("shard", F.lit("all").alias("bucket"), "records", "bytes", "sha256")
    )
    own, other = F.lit(False).alias("aggregate"), F.lit(True).alias("aggregate")
    both = manifest.select("*", own).unionByName(bundle.select("*", other))
    total = shard_total(both).first()["total"]
    held = bundle.agg(F.sum("records").alias("n")).first()["n"]
    if held != total:
        raise GateError(f"the bundle holds {held} records, the shards {total}")
    return both


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def write_awards(awards: DataFrame, path: str) -> None:
    """One JSON line per recipient, in order of the key; cents as text, exact at any size."""
    awards.orderBy("recipient").select(
        F.col("recipient").alias("abn"),
        F.col("cents").cast("string").alias("totalValueCents"),
        F.col("awards").alias("grantCount"),
        F.col("first_published").cast("string").alias("firstPublishDate"),
        F.col("last_published").cast("string").alias("lastPublishDate"),
    ).write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_comparison(report: DataFrame, path: str, noun: str = "records") -> None:
    """A build comparison as JSON lines and as a table in Markdown."""
    percent = F.coalesce(F.format_string("%+.1f%%", F.col("change") * 100), F.lit("n/a"))
    cells = F.concat_ws(" | ", "bucket", "prior", "current", percent, "status")
    head = [(0, f"| bucket | prior {noun} | current {noun} | change | status |")]
    head.append((1, "|---|---|---|---|---|"))
    lines = report.select(
        F.lit(2).alias("part"),
        F.coalesce("bucket", F.lit("")).alias("bucket"),
        F.concat(F.lit("| "), cells, F.lit(" |")).alias(_LINE),
    )
    top = report.sparkSession.createDataFrame(head, f"part int, {_LINE} string")
    table = top.select("part", F.lit("").alias("bucket"), _LINE).unionByName(lines)
    table.orderBy("part", "bucket").select(_LINE).write.mode("errorifexists").text(
        f"{path}/markdown"
    )
    report.write.mode("errorifexists").json(f"{path}/json")


def write_metadata(
    path: str,
    version: str,
    schema_version: str,
    counts: DataFrame,
    manifest: DataFrame,
    sources: DataFrame,
) -> None:
    """Release metadata: version and one table each for counts, files and sources.

    Three small JSON tables instead of one file, so no part has to fit one row.
    """
    stamp = [F.lit(version).alias("version"), F.lit(schema_version).alias("schemaVersion")]
    parts = {"counts": counts.orderBy("bucket"), "files": manifest.orderBy("shard")}
    parts["sources"] = sources
    for name, part in parts.items():
        part.select(*stamp, "*").write.mode("errorifexists").option(
            "ignoreNullFields", False
        ).json(f"{path}/{name}")
