"""One query per operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityfold.llm import (
    bpe,
    covertree,
    langid,
    licences,
    mixing,
    negatives,
    packing,
    phrases,
    quality,
    rules,
    sharding,
    simhash,
    substrings,
)
from entityfold.llm.common import fold, materialise, table

BYTE_BPE = "byte_bpe_50k.json"
LEAST_QUALITY = 0.3
SHARD_BYTES = 64 * 1024 * 1024


def op1_covertree(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.vector_links(table(spark, folder, "embeddings"), threshold=0.93)


def op2_pack(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return packing.pack_documents(table(spark, folder, "documents"), path, capacity=2048, end_id=0)


def training_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the documents that are not held out."""
    return table(spark, folder, "labels").where(fold("doc_id", 5) != 0)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machine = quality.fit(docs, training_labels(spark, folder), "quality")
    return quality.score(docs, machine).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    rows = materialise(table(spark, folder, "documents").select("doc_id", size.alias("n_bytes")), "sizes")
    return sharding.assign_shards(rows, SHARD_BYTES)


def shards_sql(limit: int) -> str:
    return f"""
        WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
                          ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS h FROM documents),
        p AS (SELECT *, h >> (60 - depth) AS prefix FROM d, (SELECT unnest(range(61)) AS depth)),
        b AS (SELECT depth, prefix, sum(n_bytes) AS shard_bytes, min(h) < max(h) AS many FROM p GROUP BY ALL),
        f AS (SELECT p.*, shard_bytes, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS o
              FROM p JOIN b USING (depth, prefix) WHERE shard_bytes <= {limit} OR NOT many)
        SELECT doc_id, n_bytes, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard, depth::INT AS depth,
               0::BIGINT AS part, shard_bytes::BIGINT AS shard_bytes
        FROM f WHERE o = 1"""


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    digest = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", digest)


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    coded = bpe.round_trip(table(spark, folder, "documents"), path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_rules(spark: SparkSession, folder: str) -> DataFrame:
    stats = materialise(rules.statistics(table(spark, folder, "documents")), "statistics")
    found = rules.fit(stats, training_labels(spark, folder), "quality")
    failed = rules.base_failed()
    return stats.select("doc_id", *rules.BASE, failed.alias("base_failed"), (~failed & rules.kept(found)).alias("kept"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").withColumn("label", negatives.moved_label())
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_covertree": op1_covertree,
    "op2_pack": op2_pack,
    "op3_quality": op3_quality,
    "op4_sharding": op4_sharding,
    "op5_licences": op5_licences,
    "op6_language": op6_language,
    "op7_substrings": op7_substrings,
    "op8_bpe": op8_bpe,
    "op9_rules": op9_rules,
    "op10_simhash": op10_simhash,
    "op11_negatives": op11_negatives,
    "op12_mixing": op12_mixing,
    "op13_phrases": op13_phrases,
}
SQL: dict[str, str] = {
    "op4_sharding": shards_sql(SHARD_BYTES),
    "op5_licences": licences.scan_sql(licences.TEMPLATES),
    "op11_negatives": negatives.NEGATIVES_SQL,
    "op12_mixing": mixing.mix_sql(),
    "op13_phrases": phrases.PHRASES_SQL,
}
