"""Scan planning: numbering workspaces into batches and hourly chunks, and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X


def number_workspaces(workspaces: DataFrame, within: str | None = None) -> DataFrame:
    """Add ``seq``, a gap-free number from 0, over all rows or per value of ``within``.

    Ids are spread over 4,096 buckets by hash and numbered per bucket in parallel; a
    running total over the bucket counts shifts each bucket to its place. Only that
    total, at most 4,096 rows per group, is computed in one window.
    """
    group = [within] if within else []
    bucketed = workspaces.filter(X.is_filled("id")).withColumn("_b", F.substring(F.md5("id"), 1, 3))
    counts = bucketed.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    local = Window.partitionBy(*group, "_b").orderBy("id")
    numbered = bucketed.withColumn("_rn", F.row_number().over(local))
    return (
        numbered.join(offsets, [*group, "_b"])
        .withColumn("seq", F.col("_offset") + F.col("_rn") - 1)
        .drop("_b", "_rn", "_offset")
    )


def plan_batches(
    workspaces: DataFrame,
    max_batches_per_hour: int,
    batch_size: int = V.WORKSPACES_PER_BATCH,
    within: str | None = None,
) -> DataFrame:
    """Workspaces with ``batch_no`` and the hourly ``chunk_no`` they belong to."""
    return in_batches(number_workspaces(workspaces, within), max_batches_per_hour, batch_size)


def in_batches(numbered: DataFrame, max_batches_per_hour: int, batch_size: int = V.WORKSPACES_PER_BATCH) -> DataFrame:
    """Batches and chunks of workspaces that have their ``seq``."""
    return numbered.withColumns({
        "batch_no": F.floor(F.col("seq") / batch_size).cast("int"),
        "chunk_no": F.floor(F.col("seq") / (batch_size * max_batches_per_hour)).cast("int"),
    })


def remaining(plan: DataFrame, completed: DataFrame) -> DataFrame:
    """Planned workspaces whose batch is not among the completed ``batch_no``."""
    return plan.join(completed.select("batch_no").distinct(), "batch_no", "left_anti")


def progress(plan: DataFrame, completed: DataFrame, max_batches_per_hour: int) -> DataFrame:
    """Batches in all, done and left, share done, and hours left at the hourly rate."""
    batches = plan.select("batch_no").distinct()
    done = completed.select("batch_no", F.lit(True).alias("_done")).distinct()
    counts = batches.join(done, "batch_no", "left").agg(
        F.count(F.lit(1)).alias("total_batches"), F.count_if(F.col("_done")).alias("completed")
    )
    left = F.col("total_batches") - F.col("completed")
    return counts.select(
        "total_batches", "completed", left.alias("remaining"),
        _share(F.col("completed"), F.col("total_batches")).alias("completed_pct"),
        F.round(left / F.lit(float(max_batches_per_hour)), 4).alias("hours_left"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, 4)).otherwise(F.lit(0.0))


def estimate(
    workspaces: DataFrame, max_batches_per_hour: int, batch_size: int = V.WORKSPACES_PER_BATCH
) -> DataFrame:
    """Batches, calls and hours a scan of these workspaces would take."""
    n = workspaces.filter(X.is_filled("id")).agg(F.count(F.lit(1)).alias("workspaces"))
    batches = F.ceil(F.col("workspaces") / batch_size)
    return n.select(
        "workspaces",
        batches.alias("batches"),
        F.round(F.col("workspaces") * float(V.CALLS_PER_BATCH) / batch_size, 4).alias("calls"),
        F.round(batches / F.lit(float(max_batches_per_hour)), 4).alias("hours"),
        F.ceil(batches / max_batches_per_hour).alias("whole_hours"),
    )
