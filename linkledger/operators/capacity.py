"""Capacity grouping, filtering and ordering of workspaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X


def capacity_key(capacity_id: str, dedicated: str) -> str:
    """The capacity a workspace is scanned under: its own when dedicated, else ``shared``."""
    return f"CASE WHEN {X.is_filled(capacity_id)} AND {dedicated} THEN {capacity_id} ELSE '{V.SHARED_KEY}' END"


def with_capacity_key(workspaces: DataFrame) -> DataFrame:
    """Add ``capacity_key``. Sources without a dedicated flag count any capacity as dedicated."""
    flag = "coalesce(isOnDedicatedCapacity, false)" if "isOnDedicatedCapacity" in workspaces.columns else "true"
    return workspaces.withColumn("capacity_key", F.expr(capacity_key("capacityId", flag)))


def distribution(keyed: DataFrame) -> DataFrame:
    """Workspaces per capacity with a short display name, largest first."""
    shown = F.when(F.col("capacity_key") == V.SHARED_KEY, F.lit("Shared Capacity")).otherwise(
        F.concat(F.lit("Capacity "), F.substring("capacity_key", 1, 8), F.lit("..."))
    )
    counts = keyed.groupBy("capacity_key").agg(F.count(F.lit(1)).alias("workspaces"))
    return counts.select("capacity_key", shown.alias("display_name"), "workspaces").orderBy(
        F.desc("workspaces"), "capacity_key"
    )


def coverage(sidecar: DataFrame) -> DataFrame:
    """How many workspaces carry capacity metadata, and on which kind of capacity."""
    dedicated = F.coalesce(F.col("is_dedicated_capacity"), F.lit(False))
    return sidecar.agg(
        F.count(F.lit(1)).alias("workspaces"),
        F.count_if(dedicated).alias("dedicated"),
        F.count_if(~dedicated).alias("shared"),
        F.count_if(F.expr(X.is_filled("capacity_id"))).alias("with_capacity_id"),
    )


def select_capacities(
    keyed: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None
) -> DataFrame:
    """Workspaces of the included capacities minus the excluded ones."""
    kept = keyed
    if include:
        kept = kept.filter(F.col("capacity_key").isin(*include))
    if exclude:
        kept = kept.filter(~F.col("capacity_key").isin(*exclude))
    return kept


def unknown_capacities(keyed: DataFrame, include: list[str]) -> DataFrame:
    """Requested capacities no workspace belongs to."""
    asked = keyed.sparkSession.createDataFrame([(c,) for c in include], "capacity_key string")
    return asked.join(keyed.select("capacity_key").distinct(), "capacity_key", "left_anti")


def ordered(counts: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """Processing order over ``(capacity_key, workspaces)``: priority list, then largest first."""
    from pyspark.sql import Window

    rank = F.array_position(F.lit(list(priority or [""])), F.col("capacity_key"))
    ranked = counts.withColumn("priority", F.nullif(rank, F.lit(0)).cast("int"))
    # One row per capacity by now, so the unpartitioned window sorts a short list.
    w = Window.orderBy(F.asc_nulls_last("priority"), F.desc("workspaces"), "capacity_key")
    return ranked.select("capacity_key", "workspaces", "priority", F.row_number().over(w).alias("position"))


def before_each(order: DataFrame) -> DataFrame:
    """``(capacity_key, position, before)``: how many workspaces the capacities ahead hold. One row per capacity."""
    from pyspark.sql import Window

    ahead = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return order.select("capacity_key", "position", F.coalesce(F.sum("workspaces").over(ahead), F.lit(0)).alias("before"))
