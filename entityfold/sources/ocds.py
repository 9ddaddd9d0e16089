"""Contract releases: JSON lines, plain or gzipped, each a release or a package of releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The parts of a release that are read.
_RELEASE = (
    "ocid:string,"
    "parties:array<struct<"
    "roles:array<string>,"
    "identifier:struct<scheme:string,id:string>,"
    "additionalIdentifiers:array<struct<scheme:string,id:string>>>>,"
    "contracts:array<struct<value:struct<amount:string>,dateSigned:string>>"
)
LINE_SCHEMA = f"struct<releases:array<struct<{_RELEASE}>>,{_RELEASE}>"

# Tells any two releases apart and orders them as they stand in the files.
POSITION = ("path", "block", "line", "pos")


def read_ocds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(ocid, parties, contracts, path, block, line, pos), one row per release.

    A line that is not JSON, or neither a release nor a package, fails the job. Blank
    lines are skipped.
    """
    lines = (
        spark.read.text(path)
        .where(F.length("value") > 0)
        .select(
            F.from_json("value", LINE_SCHEMA, {"mode": "FAILFAST"}).alias("r"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
    )
    one = F.array(F.struct("r.ocid", "r.parties", "r.contracts"))
    unknown = F.raise_error(
        F.concat(F.lit("neither a release nor a package of releases in "), "path")
    )
    releases = (
        F.when(F.col("r.releases").isNotNull(), F.col("r.releases"))
        .when(F.col("r.ocid").isNotNull(), one)
        .otherwise(unknown)
    )
    return lines.select("path", "block", "line", F.posexplode(releases).alias("pos", "x")).select(
        "x.ocid", "x.parties", "x.contracts", "path", "block", "line", "pos"
    )
