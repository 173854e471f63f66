"""Storing the connection history so that a scan costs what is open, not what has ever been.

``open`` holds the intervals that go on, as versions (see :mod:`linkledger.sinks.snapshots`) whose note names the
last scan they know. Intervals that a scan ends go to ``closed/valid_to=<scan>``, written before the new version of
``open``: a lost run writes the same folder again, and readers leave out folders after the noted scan. A read as of a scan
prunes all folders that ended before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.operators import history as H
from linkledger.schemas import CONNECTION_SCHEMA
from linkledger.sinks import snapshots as S
from linkledger.sinks.scratch import scratch_dir

NOTE = "scan"
_SCHEMA = T.StructType([*CONNECTION_SCHEMA.fields, T.StructField("valid_from", T.StringType()), T.StructField("valid_to", T.StringType())])


def record_scan(rows: DataFrame, scanned: DataFrame, scan: str, base: str) -> None:
    """Add a scan (its connections, the workspaces it looked at) to the history at ``base``.

    Scans come in the order of their time; the last one may come again, an earlier one is an error.
    """
    spark = rows.sparkSession
    last = S.read_note(spark, f"{base}/open").get(NOTE)
    if last is not None and scan < last:
        raise ValueError(f"scan {scan!r} is before the last one, {last!r}")
    work = scratch_dir(spark, "history")
    known = S.read_snapshot(spark, f"{base}/open", _SCHEMA)
    H.extend(known, rows, scanned, scan).write.parquet(work)
    done = spark.read.schema(_SCHEMA).parquet(work)
    if last != scan:  # the scan again ends nothing that it hadn't ended before
        ended = done.filter(F.col("valid_to").isNotNull()).write.partitionBy("valid_to").mode("overwrite")
        ended.option("partitionOverwriteMode", "dynamic").parquet(f"{base}/closed")
    S.write_snapshot(done.filter(F.col("valid_to").isNull()), f"{base}/open", note={NOTE: scan})
    S.delete(spark, work)


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """All intervals."""
    still = S.read_snapshot(spark, f"{base}/open", _SCHEMA)
    closed = f"{base}/closed"
    if not S.path_exists(spark, closed):
        return still
    last = S.read_note(spark, f"{base}/open").get(NOTE, "")
    return still.unionByName(spark.read.schema(_SCHEMA).parquet(closed).filter(F.col("valid_to") <= last))


def read_as_of(spark: SparkSession, base: str, scan: str) -> DataFrame:
    """The inventory as it was at ``scan``; folders of intervals that ended before are not read."""
    return H.valid_at(read_history(spark, base), scan).drop("valid_from", "valid_to")
