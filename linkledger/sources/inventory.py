"""Reading the curated inventory and the stored fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkledger.schemas import CONNECTION_SCHEMA, FINGERPRINT_SCHEMA
from linkledger.sinks import snapshots as S
from linkledger.sinks import tables as TB


def read_inventory(spark: SparkSession, source: str) -> DataFrame:
    """The inventory by table name, snapshot base path, partitioned or plain parquet path."""
    if "/" not in source:
        return spark.table(source)
    if S.current_path(spark, source) is not None or not S.path_exists(spark, source):
        return S.read_snapshot(spark, source, CONNECTION_SCHEMA)
    plain = spark.read.parquet(source)
    return TB.read_partitioned(spark, source) if TB.PART in plain.columns else plain


def read_fingerprints(spark: SparkSession, base: str) -> DataFrame:
    """Stored fingerprints; empty before the first scan."""
    return S.read_snapshot(spark, base, FINGERPRINT_SCHEMA)
