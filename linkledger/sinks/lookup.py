"""An inventory stored for looking up a few workspaces: a short list of ids reads a few row groups.

Rows are in ranges of the workspace and sorted within, in small row groups with a Bloom filter on it. A list of up to ``SHORT`` ids
becomes equalities that reach the scan: ranges and Bloom filters tell which row groups can have them. A longer list is a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkledger.schemas import CONNECTION_SCHEMA

KEY = "workspace_id"
#: Ids that become part of the scan.
SHORT = 200
#: Bytes of a row group, and the workspaces expected in a file, which the Bloom filter is made for.
ROW_GROUP, WORKSPACES = 8 << 20, 100_000


def save_lookup(rows: DataFrame, path: str, row_group: int = ROW_GROUP) -> None:
    ranged = rows.repartitionByRange(KEY).sortWithinPartitions(KEY, "item_id")
    (
        ranged.write.option("parquet.block.size", row_group)
        .option(f"parquet.bloom.filter.enabled#{KEY}", "true").option(f"parquet.bloom.filter.expected.ndv#{KEY}", WORKSPACES)
        .parquet(path)
    )


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Connections of the workspaces in ``wanted`` (``workspace_id``)."""
    rows, ids = spark.read.schema(CONNECTION_SCHEMA).parquet(path), wanted.select(KEY).distinct()
    some = [r[0] for r in ids.limit(SHORT + 1).collect()]  # SHORT + 1 rows at most
    if len(some) > SHORT:
        return rows.join(ids, KEY, "left_semi")
    # Equalities, not a list: of a list longer than a few the scan gets its least and greatest value only.
    return rows.filter(reduce(lambda a, b: a | b, [F.col(KEY) == i for i in some if i is not None], F.lit(False)))
