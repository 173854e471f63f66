"""Activity events: unnesting landed pages, inbound access and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X
from linkledger.schemas import ACTIVITY_DDL

_INBOUND = {
    "timestamp": "CreationTime", "activity": "Activity", "user": "UserId", "client_ip": "ClientIP",
    "user_agent": "UserAgent", "workspace_id": "WorkspaceId", "workspace_name": "WorkspaceName",
    "dataset_id": "DatasetId", "dataset_name": "DatasetName", "report_id": "ReportId",
    "report_name": "ReportName", "is_success": "IsSuccess",
}


def unnest_pages(pages: DataFrame) -> DataFrame:
    """Landed event pages (``text``) to one row per event; continuation tokens are dropped."""
    ddl = f"activityEventEntities array<{ACTIVITY_DDL}>, continuationToken string"
    return (
        pages.select(F.explode(F.from_json("text", ddl)["activityEventEntities"]).alias("e"))
        .filter(F.col("e").isNotNull())
        .select("e.*")
    )


def land_events(events: DataFrame, path: str) -> None:
    """Append events as parquet by ``event_date``, with their time as a timestamp in ``created_at``.

    The date is the first ten characters of the time as written, in UTC, so it doesn't depend on
    the session; events without a readable time go to the folder of no date.
    """
    at = F.try_to_timestamp("CreationTime")
    dated = events.withColumn("created_at", at).withColumn("event_date", F.when(at.isNotNull(), F.substring("CreationTime", 1, 10)))
    dated.write.mode("append").partitionBy("event_date").parquet(path)


def read_events(
    spark: SparkSession, path: str, end: Column, days: float = 30, activity: str | None = None, keep_time: bool = False
) -> DataFrame:
    """Landed events of ``[end - days, end)``; folders outside the window are not read.

    Folders are compared with a day to spare on both sides, for times written with an offset. The times are those parsed
    when the events landed; ``keep_time`` leaves them in ``created_at``.
    """
    start, day = window_start(end, days), "yyyy-MM-dd"
    schema = T.StructType.fromDDL(f"{ACTIVITY_DDL.removeprefix('struct<').removesuffix('>').replace(':', ' ')}, created_at timestamp, event_date string")
    rows = spark.read.schema(schema).parquet(path).filter(
        (F.col("event_date") >= F.date_format(start - F.make_dt_interval(days=F.lit(1)), day))
        & (F.col("event_date") <= F.date_format(end + F.make_dt_interval(days=F.lit(1)), day))
        & (F.col("created_at") >= start) & (F.col("created_at") < end)
    )
    kept = rows if activity is None else rows.filter(F.col("Activity") == activity)
    return kept.drop("event_date") if keep_time else kept.drop("created_at", "event_date")


def window_start(end: Column, days: float) -> Column:
    return end - F.make_dt_interval(secs=F.lit(float(days) * 86400))


def in_window(events: DataFrame, end: Column, days: float = 30, activity: str | None = None) -> DataFrame:
    """Events with ``CreationTime`` in ``[end - days, end)``, optionally of one activity."""
    at = F.try_to_timestamp("CreationTime")
    kept = events.filter((at >= window_start(end, days)) & (at < end))
    return kept if activity is None else kept.filter(F.col("Activity") == activity)


def day_tiles(events: DataFrame, end: Column, days: int = 30) -> DataFrame:
    """Events per 24-hour tile counted from the window's start; empty tiles are listed too.

    Times that were parsed before (``created_at``) are not parsed again.
    """
    start = window_start(end, days)
    at = F.col("created_at") if "created_at" in events.columns else F.try_to_timestamp("CreationTime")
    tile = F.floor((F.unix_micros(at) - F.unix_micros(start)) / F.lit(86_400_000_000)).cast("int")
    counts = events.filter((at >= start) & (at < end)).groupBy(tile.alias("tile")).agg(F.count(F.lit(1)).alias("n"))
    spark = events.sparkSession
    tiles = spark.range(days).select(F.col("id").cast("int").alias("tile"))
    begin = start + F.make_dt_interval(days=F.col("tile"))
    return tiles.join(counts, "tile", "left").select(
        "tile",
        begin.alias("tile_start"),
        F.least(begin + F.make_dt_interval(days=F.lit(1)), end).alias("tile_end"),
        F.coalesce("n", F.lit(0)).cast("long").alias("events"),
    )


def inbound(events: DataFrame) -> DataFrame:
    """Programmatic access: one of the inbound activities with a user agent that is no browser.

    Success defaults to true when the event does not say.
    """
    kept = events.filter(
        f"Activity IN ({X.quoted(*V.INBOUND_ACTIVITIES)}) AND {X.is_filled('UserAgent')} "
        f"AND NOT startswith(UserAgent, {X.quoted(V.BROWSER_PREFIX)})"
    )
    return kept.selectExpr(*[
        f"coalesce({src}, true) AS {out}" if out == "is_success" else f"{src} AS `{out}`"
        for out, src in _INBOUND.items()
    ])


def summary(inbound_events: DataFrame, approximate: bool = False) -> DataFrame:
    """Calls and distinct users, addresses and workspaces; nulls are not counted.

    ``approximate`` trades exact distinct counts for fixed-size sketches on huge logs.
    """
    def distinct(c: str) -> Column:
        return F.approx_count_distinct(c) if approximate else F.count_distinct(F.col(c))

    return inbound_events.agg(
        F.count(F.lit(1)).alias("calls"),
        distinct("user").alias("users"),
        distinct("client_ip").alias("ips"),
        distinct("workspace_id").alias("workspaces"),
    )


def top_activities(inbound_events: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent activities by events that carry a time; name breaks ties."""
    counts = inbound_events.groupBy("activity").agg(F.count("timestamp").alias("events"))
    return counts.orderBy(F.desc("events"), "activity").limit(n)
