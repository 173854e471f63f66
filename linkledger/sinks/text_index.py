"""An inventory stored for substring search on a text column, by a trigram posting table.

Three tables: the column's distinct ``texts``; ``postings``, a row for each text and trigram in it, in parts by trigram and
sorted by it; and the ``rows``, in parts by text and sorted by that. A search reads the parts of its own trigrams,
takes the texts that have all of them, checks these with ``contains`` and reads the parts of rows with the texts found.

A posting list is rows, not an array, so a trigram of every text is no larger a value than any other. Shorter needles than a
trigram, which have no list, are looked for in the texts themselves. Null texts match nothing and aren't stored as
texts; their rows are kept, so that the stored rows are the whole inventory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
PARTS = 64
_GRAMS = f"array_distinct(transform(sequence(1, length(text) - {GRAM - 1}), i -> substring(text, i, {GRAM})))"


def _part(of: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(parts)).cast("int")


def _sorted(rows: DataFrame, part: Column, by: str, path: str) -> None:
    """Write in parts, each by one task at a time, sorted within."""
    placed = rows.withColumn("_part", part)
    placed.repartition("_part", by).sortWithinPartitions("_part", by).write.partitionBy("_part").parquet(path)


def save_index(rows: DataFrame, column: str, base: str, parts: int = PARTS) -> None:
    """Store ``rows`` at ``base`` for searches on ``column``."""
    spark = rows.sparkSession
    keyed = rows.withColumn("text_id", F.md5(F.col(column)))
    _sorted(keyed, _part("text_id", parts), "text_id", f"{base}/rows")
    texts = spark.read.parquet(f"{base}/rows").filter("text_id IS NOT NULL").select("text_id", F.col(column).alias("text")).distinct()
    texts.write.parquet(f"{base}/texts")
    grams = spark.read.parquet(f"{base}/texts").filter(f"length(text) >= {GRAM}").selectExpr("text_id", f"explode({_GRAMS}) AS gram")
    _sorted(grams, _part("gram", parts), "gram", f"{base}/postings")
    spark.createDataFrame([(parts,)], "parts int").coalesce(1).write.parquet(f"{base}/layout")


def _in_parts(spark: SparkSession, path: str, keys: DataFrame, key: str, parts: int) -> DataFrame:
    """The rows of a table in parts whose ``key`` is among the keys; other parts are not read."""
    wanted = [r[0] for r in keys.select(_part(key, parts)).distinct().collect()]  # PARTS rows at most
    return spark.read.parquet(path).filter(F.col("_part").isin(wanted)).join(keys, key, "left_semi").drop("_part")


def matching_texts(spark: SparkSession, base: str, needle: str) -> DataFrame:
    """``text_id`` of the texts that contain the needle, as ``LIKE '%needle%'`` would find them."""
    grams = sorted({needle[i : i + GRAM] for i in range(len(needle) - GRAM + 1)})
    texts = spark.read.parquet(f"{base}/texts")
    if grams:
        parts = spark.read.parquet(f"{base}/layout").first()[0]
        wanted = spark.createDataFrame([(g,) for g in grams], "gram string")
        places = [r[0] for r in wanted.select(_part("gram", parts)).distinct().collect()]
        # The trigrams are literals, so the scan skips row groups without them.
        lists = spark.read.parquet(f"{base}/postings").filter(F.col("_part").isin(places) & F.col("gram").isin(grams))
        candidates = lists.groupBy("text_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams))
        texts = texts.join(candidates.select("text_id"), "text_id", "left_semi")
    return texts.filter(F.col("text").contains(needle)).select("text_id")


def search(spark: SparkSession, base: str, needle: str) -> DataFrame:
    """The stored rows whose text contains the needle."""
    parts = spark.read.parquet(f"{base}/layout").first()[0]
    return _in_parts(spark, f"{base}/rows", matching_texts(spark, base, needle), "text_id", parts).drop("text_id")
