"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkledger.sinks.scratch import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def landed(df: DataFrame, name: str, compression: str = "zstd", per_file: int = 0) -> DataFrame:
    """``df`` written once under the shared folder and read back; cuts the lineage.

    A lost executor repeats only the tasks of one side, and rows that later steps read
    several times (or give numbers to) are the same rows each time. ``per_file`` bounds the rows of a file, for rows of
    megabytes: readers of columns take all rows of a file at once, up to 4,096.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    writer = df.write.option("compression", compression)
    (writer.option("maxRecordsPerFile", per_file) if per_file else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """A shared folder for what an operator lands on its way; all of it goes at the end, once the result is landed elsewhere."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.n = spark, scratch_dir(spark, f"llm-{name}"), 0

    def __enter__(self) -> Workspace:
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written under a name and read back, as :func:`landed` does.

        These are many small files of hashes and numbers: zstd would make them little smaller, and its contexts, one a
        column and file, are memory outside the heap until they are collected.
        """
        self.n += 1
        path = f"{self.path}/{self.n}-{name}"
        df.write.option("compression", "snappy").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key``, a row number, is in ``ids``; they stay where they are, however wide.

    Numbers are broadcast as the bits of 64-bit words, less than a byte a row where they follow each other.
    """
    word, bits = unused(rows, "word"), unused(rows, "bits")
    words = ids.groupBy(F.expr(f"{key} div 64").alias(word)).agg(F.expr(f"bit_or(shiftleft(1L, CAST({key} % 64 AS int)))").alias(bits))
    there = rows.join(F.broadcast(words), F.expr(f"{key} div 64") == F.col(word))
    return there.where(F.expr(f"getbit({bits}, CAST({key} % 64 AS int)) = 1")).drop(word, bits)


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case, every other character as it is; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, UPPER.lower())


#: Most bytes of rows that a Python worker gets at once.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Make the session ready for this package's Python workers.

    Batches are small, so that long texts don't add up in a worker, and the package is made
    importable as ``--py-files`` does where the Python path doesn't have it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    found = os.environ.get("PYTHONPATH", "").split(os.pathsep) + [os.getcwd()] * sc.master.startswith("local[")
    if root in found or getattr(sc, "_linkledger_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="linkledger-package-")  # the driver serves it from there
    sc.addPyFile(shutil.make_archive(f"{folder}/linkledger", "zip", root, "linkledger"))
    sc._linkledger_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
