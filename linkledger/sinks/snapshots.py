"""Versioned parquet snapshots: a table is never overwritten while it is being read.

Every write goes to a new ``v<number>`` directory under the table's base path and counts
only once Spark has put its ``_SUCCESS`` marker there. Readers take the highest complete
version. A job lost half-way leaves an incomplete directory that nobody reads.

Old versions stay until :func:`vacuum` is called. A version can carry a note, such as the
last batch that went into it; it counts together with the version.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.sinks.scratch import DENSE

_VERSION = re.compile(r"^v(\d{8})$")


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs, _ = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a working folder whose content has been written elsewhere."""
    p, fs, _ = _fs(spark, path)
    fs.delete(p, True)


def rename_only_file(spark: SparkSession, folder: str, to: str) -> str:
    """Give the one part file of a finished write its final name; the folder goes."""
    p, fs, jpath = _fs(spark, folder)
    (part,) = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")]
    target = jpath(to)
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"cannot rename {part.toString()} to {to}")
    fs.delete(p, True)
    return to


def numbered(spark: SparkSession, base: str) -> list[tuple[int, bool]]:
    """Version numbers under ``base`` with whether each is complete, ascending."""
    p, fs, jpath = _fs(spark, base)
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        m = _VERSION.match(status.getPath().getName())
        if m:
            found.append((int(m.group(1)), fs.exists(jpath(status.getPath(), "_SUCCESS"))))
    return sorted(found)


def current_path(spark: SparkSession, base: str) -> str | None:
    """Directory of the newest complete version, or None."""
    complete = [n for n, done in numbered(spark, base) if done]
    return f"{base}/v{complete[-1]:08d}" if complete else None


def read_snapshot(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The newest complete version; an empty table of ``schema`` when there is none."""
    path = current_path(spark, base)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_note(spark: SparkSession, base: str) -> dict:
    """What the newest complete version's writer noted."""
    path = current_path(spark, base)
    note = f"{base}/notes/{path.rsplit('/', 1)[1]}" if path else None
    if note is None or not path_exists(spark, note):
        return {}
    return json.loads(spark.read.text(note).first().value)


def write_note(spark: SparkSession, base: str, version: int, note: dict) -> None:
    """What is to be known of a version; written before it, so it counts together with it."""
    text = spark.createDataFrame([(json.dumps(note),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{base}/notes/v{version:08d}")


def write_snapshot(
    df: DataFrame, base: str, partition_by: list[str] | None = None, note: dict | None = None
) -> tuple[str, int]:
    """Write the next version; returns its path and rows, counted while they are written.

    Without a ``note`` of its own the version keeps the one before it.
    """
    spark = df.sparkSession
    versions = numbered(spark, base)
    name = f"v{(versions[-1][0] + 1 if versions else 1):08d}"
    noted = read_note(spark, base) if note is None else note
    if noted:
        write_note(spark, base, int(name[1:]), noted)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**DENSE).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{name}")
    return f"{base}/{name}", int(seen.get["rows"])


def table_location(spark: SparkSession, table: str) -> str:
    """Where a registered table's data is."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type


def vacuum(spark: SparkSession, base: str, keep: int = 2, tables: tuple[str, ...] = ()) -> None:
    """Delete complete versions beyond the newest ``keep``, but none that a table points at.

    ``tables`` are the tables registered for this inventory. Call it when no reader of an
    older version is left. Incomplete directories stay: one of them may be another
    writer's work in progress.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    used = {table_location(spark, t).rstrip("/").rsplit("/", 1)[1] for t in tables}
    complete = [n for n, done in numbered(spark, base) if done]
    for n in complete[:-keep]:
        if f"v{n:08d}" not in used:
            p, fs, _ = _fs(spark, f"{base}/v{n:08d}")
            fs.delete(p, True)
