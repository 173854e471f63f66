"""Saving the inventory: snapshot, partitioned table, external table, CSV copy, raw landing."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from linkledger.operators import merge as M
from linkledger.schemas import CONNECTION_COLUMNS, CONNECTION_SCHEMA
from linkledger.sinks import snapshots as S
from linkledger.sinks.scratch import DENSE, scratch_dir

# Fixed value: what a table name may consist of.
_IDENTIFIER = re.compile(r"[a-zA-Z0-9_\.]+")

#: Partition column of a partitioned inventory, and the mark of a connection; one row without
#: it is in every partition, so that a partition whose connections all go is rewritten too.
PART, LIVE = "_part", "_live"

#: Landed documents and CSV lines in a file: compressed files and CSV with line breaks don't split, so a file is one task's.
PER_FILE, CSV_PER_FILE = 500, 200_000

#: Null and empty text stay apart, line breaks and quotes come back as they were. A value
#: that is the null mark itself would come back as null.
CSV_OPTIONS = {
    "header": True, "quoteAll": True, "quote": '"', "escape": '"', "nullValue": "␀", "emptyValue": "", "multiLine": True,
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def check_identifier(name: str, label: str = "identifier") -> str:
    """The name if it is letters, digits, underscores and dots only; else ValueError."""
    if not name or not _IDENTIFIER.fullmatch(name):
        raise ValueError(
            f"Invalid {label} {name!r}: only letters, digits, underscores and dots are allowed"
        )
    return name


def register_table(spark: SparkSession, table: str, path: str) -> None:
    """Point an external parquet table at ``path``; the data itself is not touched.

    A table that is there already is moved in one step, so it never misses.
    """
    check_identifier(table, "table name")
    location = path.replace("'", "\\'")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING PARQUET LOCATION '{location}'")


def _merged(existing: DataFrame, rows: DataFrame, keep: str, scanned: DataFrame | None) -> DataFrame:
    """Stored rows merged into an inventory, dealt by workspace."""
    return M.by_workspace(
        lambda old, new: M.merge(old, new, keep) if scanned is None else M.replace_scanned(old, new, scanned), existing, rows
    )


@contextmanager
def staged(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows landed for as long as a job reads them, some several times. Repeated texts take next to nothing in columns."""
    spark, work = rows.sparkSession, scratch_dir(rows.sparkSession, "staged")
    try:
        rows.write.options(**DENSE).parquet(work)
        yield spark.read.schema(rows.schema).parquet(work)
    finally:
        S.delete(spark, work)


def save_inventory(
    rows: DataFrame,
    base: str,
    table: str | None = None,
    mode: str = "overwrite",
    keep: str = "incoming",
    scanned: DataFrame | None = None,
    note: dict | None = None,
    landed: bool = False,
) -> int:
    """Normalise, de-duplicate and save connection rows; returns the number of rows saved.

    ``overwrite`` replaces the inventory, ``merge`` (also called ``append``) combines it
    with what is there. Given the ``scanned`` workspaces (``workspace_id``), a merge also
    removes what these no longer have. ``note`` is stored with the version. ``landed`` rows are read as they are, not landed again.
    """
    spark = rows.sparkSession
    if table:
        check_identifier(table, "table name")
    if mode == "overwrite":
        path, n = S.write_snapshot(M.dedup(rows), base, note=note)
    elif mode in ("merge", "append"):
        with nullcontext(rows) if landed else staged(rows) as new:
            path, n = S.write_snapshot(_merged(S.read_snapshot(spark, base, CONNECTION_SCHEMA), new, keep, scanned), base, note=note)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if table:
        register_table(spark, table, path)
    return n


def merge_partitioned(
    rows: DataFrame, base: str, keep: str = "incoming", parts: int = 64, scanned: DataFrame | None = None,
    landed: bool = False,
) -> int:
    """Merge into an inventory kept in hash partitions by workspace; returns the rows of those rewritten.

    Only partitions that hold a workspace of ``rows`` or ``scanned`` are read and written. The new
    content is staged before it replaces them. The number of partitions is that of the first call.

    Unlike versions, partitions are replaced in place: a read at that moment can fail and is to be repeated, and a job
    lost while it commits is to be run again, which gives the same content. Readers that can't wait take a version.
    """
    with nullcontext(rows) if landed else staged(rows) as new:
        return _replace_partitions(new, base, keep, parts, scanned)


def _replace_partitions(rows: DataFrame, base: str, keep: str, parts: int, scanned: DataFrame | None) -> int:
    spark = rows.sparkSession
    there = S.path_exists(spark, base)
    if there:
        parts = int(spark.read.parquet(base).select(PART).first()[0].split("-of-")[1])
    part = f"concat(pmod(xxhash64(workspace_id), {int(parts)}), '-of-{int(parts)}')"
    ids = rows.select("workspace_id") if scanned is None else rows.select("workspace_id").unionByName(scanned.select("workspace_id"))
    touched = [r[0] for r in ids.selectExpr(f"{part} AS p").distinct().collect()]  # one value a partition
    if not touched:
        return 0
    existing = spark.createDataFrame([], CONNECTION_SCHEMA)
    if there:
        existing = _partitions(spark, base).filter(F.col(PART).isin(touched) & F.col(LIVE)).select(*CONNECTION_COLUMNS)
    marks = spark.createDataFrame([(p, False) for p in touched], f"{PART} string, {LIVE} boolean")
    merged = _merged(existing, rows, keep, scanned).selectExpr("*", f"{part} AS {PART}", f"true AS {LIVE}")
    work, seen = scratch_dir(spark, "partitions"), Observation()
    merged.observe(seen, F.count(F.lit(1)).alias("rows")).unionByName(marks, allowMissingColumns=True).write.options(**DENSE).parquet(work)
    spark.read.parquet(work).hint("rebalance", PART).write.options(**DENSE).partitionBy(PART).option("partitionOverwriteMode", "dynamic").mode(
        "overwrite"
    ).parquet(base)
    S.delete(spark, work)
    return int(seen.get["rows"])


def _partitions(spark: SparkSession, base: str) -> DataFrame:
    schema = T.StructType([*CONNECTION_SCHEMA.fields, T.StructField(LIVE, T.BooleanType()), T.StructField(PART, T.StringType())])
    return spark.read.schema(schema).parquet(base)


def read_partitioned(spark: SparkSession, base: str) -> DataFrame:
    """The connections of a partitioned inventory."""
    return _partitions(spark, base).filter(LIVE).select(*CONNECTION_COLUMNS)


def save_csv(rows: DataFrame, path: str) -> None:
    """CSV copy, compressed, with a header line in every file; :func:`read_csv` gives the same rows back."""
    files = rows.write.mode("overwrite").options(**CSV_OPTIONS).option("compression", "gzip")
    files.option("maxRecordsPerFile", CSV_PER_FILE).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def land_payloads(payloads: DataFrame, path: str, compression: str = "none") -> None:
    """Land payloads as JSON lines under ``scan_kind=<kind>/scan_date=<date>``.

    ``payloads`` has ``scan_kind`` (full, incremental, by_id), ``scan_date`` and the ``payload``
    struct. Many payloads share a file, and such files split when they are read; with ``compression`` they don't, so they
    hold up to ``PER_FILE``. Their names then end in, say, ``.json.gz``.
    """
    files = payloads.select("scan_kind", "scan_date", "payload.*").write.mode("append").partitionBy("scan_kind", "scan_date")
    if compression != "none":
        files = files.option("maxRecordsPerFile", PER_FILE)
    files.option("compression", compression).json(path)


def land_scan(payloads: DataFrame, folder: str, scan_id: str) -> str:
    """Land the payload objects (``text``) of one finished scan as one file, ``<scan_id>.json``, a list; returns its path.

    The file appears under its name once it is whole, and takes the place of one that is there.
    """
    spark, work = payloads.sparkSession, scratch_dir(payloads.sparkSession, "scan")
    last = F.lead("text").over(W.orderBy("text")).isNull()
    lines = payloads.select("text").withColumn("_end", F.when(last, "]").otherwise(","))
    first = F.when(F.row_number().over(W.orderBy("text")) == 1, "[").otherwise("")
    lines.select(F.concat(first, "text", "_end")).coalesce(1).write.text(work)
    return S.rename_only_file(spark, work, f"{folder}/{scan_id}.json")


def save_analysis(rows: DataFrame, path: str) -> None:
    """An analysis result as parquet and, beside it, CSV made from that; earlier results stay until the new one is complete."""
    saved, _ = S.write_snapshot(rows, f"{path}/parquet")
    save_csv(rows.sparkSession.read.parquet(saved), f"{path}/csv")


def create_table_as(rows: DataFrame, table: str) -> None:
    """Derived inventory as a managed table."""
    rows.write.mode("overwrite").saveAsTable(check_identifier(table, "table name"))
