"""Request-log reports: projected call rate and contention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V


def request_rate(log: DataFrame, *group: str) -> DataFrame:
    """Calls, minutes elapsed, calls projected per hour, share of the limit and its band."""
    stats = log.groupBy(*group).agg(
        F.count(F.lit(1)).alias("calls"),
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).alias("seconds"),
    )
    rate = F.when(F.col("seconds") > 0, F.col("calls") / F.col("seconds") * 3600).otherwise(F.lit(0.0))
    rated = stats.withColumn("rate", rate)
    band = (
        F.when(F.col("rate") > V.RATE_WARNING, F.lit("warning"))
        .when(F.col("rate") > V.RATE_MODERATE, F.lit("moderate"))
        .otherwise(F.lit("healthy"))
    )
    return rated.select(
        *group, "calls",
        F.round(F.col("seconds") / 60, 4).alias("elapsed_minutes"),
        F.round("rate", 4).alias("rate_per_hour"),
        F.round(F.col("rate") / V.HOURLY_LIMIT * 100, 4).alias("percentage_used"),
        band.alias("band"),
    )


def contention_status(log: DataFrame, *group: str) -> DataFrame:
    """Contention from the share of throttled requests (status 429).

    A single throttled call among four or more counts as light before the share is
    looked at.
    """
    counts = log.groupBy(*group).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") == 429).alias("throttled"),
        F.count_if(F.col("status") == 200).alias("successful"),
    )
    share = F.col("throttled") * 100.0 / F.col("requests")
    status = (
        F.when(F.col("throttled") == 0, F.lit("clear"))
        .when((F.col("throttled") == 1) & (F.col("requests") >= 4), F.lit("light"))
        .when(share >= 50, F.lit("heavy"))
        .otherwise(F.lit("moderate"))
    )
    named = counts.withColumns({"status": status, "throttled_pct": F.round(share, 4)})

    def by_status(clear: int, light: int, heavy: int, moderate: int):
        c = F.col("status")
        return (
            F.when(c == "clear", F.lit(clear)).when(c == "light", F.lit(light))
            .when(c == "heavy", F.lit(heavy)).otherwise(F.lit(moderate))
        )

    return named.select(
        *group, "requests", "successful", "throttled", "throttled_pct", "status",
        by_status(3, 1, 1, 2).alias("recommended_parallel"),
        by_status(0, 100, 400, 250).alias("estimated_other_usage"),
        (F.col("status") != "heavy").alias("safe_to_proceed"),
    )
