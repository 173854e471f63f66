"""Sketches of the inbound activity kept per day, from which any window is answered without its events.

A day of any size is one row: its calls, a HyperLogLog sketch of each counted column and a frequent-items sketch of each
ranked one. Windows join their days' sketches. Days that a window covers in part are read as events and sketched then.

Distinct counts are estimates: the relative standard error of a sketch of 2^k registers is 1.04 / sqrt(2^k), 1.6 % for the 12
used here; :data:`WITHIN` is four of it. Ranked values are exact: sketches propose, the events of the window count, and the
sketch's own bound says whether a value it doesn't hold could be among the first; if so, all are counted.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Registers of a distinct-count sketch, as a power of two, and the relative error that its estimates stay within.
LOG_REGISTERS = 12
WITHIN = 4 * 1.04 / 2 ** (LOG_REGISTERS / 2)
#: Counters of a frequent-items sketch.
COUNTERS = 4096
COUNTED = {"user": "users", "client_ip": "ips", "workspace_id": "workspaces"}
RANKED = ("activity", "user")
DAY = "event_date"


def daily(inbound_events: DataFrame) -> DataFrame:
    """One row a day: ``event_date`` (null without a readable time), calls, sketches. Combined before the shuffle."""
    at = F.try_to_timestamp("timestamp")
    dated = inbound_events.withColumn(DAY, F.date_format(at, "yyyy-MM-dd"))
    return dated.groupBy(DAY).agg(*_sketches())


def _sketches() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("calls"),
        *[F.hll_sketch_agg(c, LOG_REGISTERS).alias(f"{name}_sketch") for c, name in COUNTED.items()],
        # Only events that carry a time are ranked.
        *[F.expr(f"approx_top_k_accumulate(CASE WHEN timestamp IS NOT NULL THEN {c} END, {COUNTERS})").alias(f"{c}_top") for c in RANKED],
        *[F.count(F.when(F.col("timestamp").isNotNull(), F.col(c))).alias(f"{c}_ranked") for c in RANKED],
    ]


def store(sketches: DataFrame, path: str) -> None:
    """Write the days' sketches; a day that is written again replaces itself."""
    sketches.write.partitionBy(DAY).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "false").parquet(path).withColumn(DAY, F.col(DAY).cast("string"))


def whole_days(start: str, end: str) -> tuple[str, str]:
    """First and last date, the last exclusive, of the days that lie in ``[start, end)`` as a whole; both are times in UTC."""
    midnight = start[11:] in ("", "00:00:00")
    first = start[:10] if midnight else str(date.fromisoformat(start[:10]) + timedelta(days=1))
    return first, end[:10]


def window(sketches: DataFrame, events: DataFrame, start: str, end: str) -> DataFrame:
    """One row with the sketches of ``[start, end)``: stored days, and the events of days at its edges."""
    first, last = whole_days(start, end)
    at = F.try_to_timestamp("timestamp")
    stored = sketches.filter((F.col(DAY) >= first) & (F.col(DAY) < last)).drop(DAY)
    edge = events.filter((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))
    day = F.date_format(at, "yyyy-MM-dd")
    rest = edge.filter((day < first) | (day >= last)).agg(*_sketches())
    return stored.unionByName(rest).agg(
        F.sum("calls").alias("calls"),
        *[F.hll_union_agg(f"{name}_sketch").alias(f"{name}_sketch") for name in COUNTED.values()],
        *[F.expr(f"approx_top_k_combine({c}_top, {COUNTERS})").alias(f"{c}_top") for c in RANKED],
        *[F.sum(f"{c}_ranked").alias(f"{c}_ranked") for c in RANKED],
    )


def summary(joined: DataFrame) -> DataFrame:
    """Calls, which are exact, and estimates of the distinct users, addresses and workspaces of a window."""
    return joined.select("calls", *[F.hll_sketch_estimate(f"{name}_sketch").alias(name) for name in COUNTED.values()])


def top(joined: DataFrame, events: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The most frequent values of a ranked column among the window's ``events``, exactly; value breaks ties.

    Only events with a proposed value are counted. A value that the sketch lost occurs at most ``ranked / (0.75 *
    COUNTERS)`` times (its stated bound). If the last of the first ``n`` isn't above that, and the proposed ones aren't
    all there are, every value is counted.
    """
    row = joined.select(F.col(f"{column}_ranked").alias("ranked"), F.expr(f"approx_top_k_estimate({column}_top, {4 * n})").alias("top")).first()
    ranked = row["ranked"] or 0
    counts = _counts(events.filter(F.col(column).isin([t["item"] for t in row["top"] or []])), column)
    found = counts.collect()  # 4 n rows at most
    lost = ranked / (0.75 * COUNTERS)
    if sum(r["events"] for r in found) < ranked and (len(found) < n or found[n - 1]["events"] <= lost):
        return _counts(events, column).limit(n)
    return events.sparkSession.createDataFrame(found[:n], counts.schema)


def _counts(events: DataFrame, column: str) -> DataFrame:
    counted = events.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("timestamp").alias("events"))
    return counted.orderBy(F.desc("events"), column)


def distinct_within(estimate: str, exact: str) -> Column:
    """Whether an estimate is within the stated error of an exact count."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.ceil(F.col(exact) * WITHIN)
