"""Queries of this package over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkledger.llm import (
    collocations, decontaminate, exactdedup, langid, licenses, manifest, mixing, quality, sentencepieces, sharding, simhash, sql,
    tokencount, tokenfile,
)
from linkledger.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards of nearly equal bytes."""
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), 40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.identified(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document; its source is the host, its source and language the path."""
    docs = table(spark, sf_dir, "documents")
    rows = quality.score_documents(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return rows.withColumn("kept", F.col("score") >= 0.5)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    rows = tokencount.count_tokens(table(spark, sf_dir, "documents"))
    return rows.withColumn("over_limit", F.col("n_tokens") > tokencount.OVER)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold test items, a row for each item found."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the group of near-duplicates it is in."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", licenses.scanned(docs).alias("s")).select("doc_id", "s.*")


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, from the file of ids."""
    return tokenfile.written_and_read(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its group that stays."""
    return exactdedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and the root its tampered leaf folds to."""
    docs = table(spark, sf_dir, "documents")
    return manifest.manifest(docs, manifest.lower_cased(docs))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's pieces and of what they decode to, and the source bytes that their spans cover."""
    return sentencepieces.digests(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.phrases(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_language_id": op2_language_id,
    "op3_quality": op3_quality,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_license_scan": op7_license_scan,
    "op8_token_file": op8_token_file,
    "op9_mixing": op9_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_manifest": op11_manifest,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op10_exact_dedup": sql.EXACT_DEDUP,
    "op11_manifest": sql.manifest(),
    "op13_collocations": sql.collocations(),
}
