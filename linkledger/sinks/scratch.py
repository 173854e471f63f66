"""Shared working folders for data that a job has to land between two steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Parquet of working folders and versions: nested and repeated texts take less than half of the default's bytes.
DENSE = {"compression": "zstd"}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of its
    own; on a cluster such a folder would not be shared, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="linkledger-")
    return f"{base.rstrip('/')}/linkledger-{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each action inside go when it ends; else they stay until the driver happens to collect its garbage.

    The session's own setting is put back.
    """
    before = spark.conf.getAll.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
