"""Connection history: from when to when a connection was there, with which attributes.

Scans observe workspaces. A connection is there from the first scan that has it up to, and without, the next scan of its
workspace that doesn't; a scan that didn't look at the workspace says nothing. An interval is a run of consecutive
scans of the workspace with the same row: any other column that changes ends it and begins another, so the rows valid at a
scan are exactly the inventory as it was then. ``valid_to`` is null while the connection is there.

Scans are texts in the order of their time, such as ``2024-01-31`` or ``2024-01-31T120000Z``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkledger.operators import merge as M
from linkledger.schemas import CONNECTION_COLUMNS, CONNECTION_KEY

_REST = [c for c in CONNECTION_COLUMNS if c not in CONNECTION_KEY]
_ATTRIBUTES = f"struct({', '.join(_REST)})"
INTERVAL_COLUMNS = [*CONNECTION_COLUMNS, "valid_from", "valid_to"]


def _one_per_scan(rows: DataFrame) -> DataFrame:
    """One row per connection and scan, the smallest of the copies."""
    kept = M.normalise(rows).groupBy(*CONNECTION_KEY, "scan").agg(F.expr(f"min({_ATTRIBUTES}) AS _kept"))
    return kept.selectExpr(*CONNECTION_KEY, "scan", "_kept")


def history(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Intervals of the connections of many scans.

    ``rows`` are connections with their ``scan``, ``seen`` has every ``workspace_id`` and ``scan`` that looked at it, also
    without finding anything. A connection's observations are one window: as many rows as its workspace has scans.
    """
    # Each step is by the workspace or by keys that begin with it, so rows dealt by workspace once stay where they are.
    scans = seen.groupBy("workspace_id").agg(F.expr("array_sort(collect_set(scan)) AS _scans"))
    found = _one_per_scan(M.dealt(rows)).join(scans, "workspace_id").withColumn("_seq", F.expr("array_position(_scans, scan)"))
    found = found.filter("_seq > 0").withColumn("_next", F.expr("get(_scans, CAST(_seq AS int))")).drop("_scans")
    of_key = W.partitionBy(*CONNECTION_KEY).orderBy("_seq")
    goes_on = F.lag("_seq").over(of_key).eqNullSafe(F.col("_seq") - 1) & F.lag("_kept").over(of_key).eqNullSafe(F.col("_kept"))
    runs = found.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(of_key))
    packed = runs.groupBy(*CONNECTION_KEY, "_run").agg(
        F.min("scan").alias("valid_from"), F.expr("max_by(struct(_kept, _next), _seq) AS _last")
    )
    return packed.selectExpr(*CONNECTION_KEY, "_last._kept.*", "valid_from", "_last._next AS valid_to").select(*INTERVAL_COLUMNS)


def extend(open_intervals: DataFrame, rows: DataFrame, scanned: DataFrame, scan: str) -> DataFrame:
    """Open intervals after one more scan; those it ended have a ``valid_to``.

    Needs no earlier scan and no closed interval: open intervals and the scan's rows meet in one aggregation on the key.
    ``scanned`` holds the workspaces the scan looked at. The same scan again changes nothing.
    """
    known = M.dealt(open_intervals).selectExpr(*CONNECTION_KEY, f"{_ATTRIBUTES} AS _kept", "valid_from", "0 AS _side")
    looked = scanned.select("workspace_id").distinct().withColumn("_looked", F.lit(True))
    fresh = _one_per_scan(M.dealt(rows).withColumn("scan", F.lit(scan))).join(looked, "workspace_id", "left_semi")
    both = known.unionByName(fresh.select(*CONNECTION_KEY, "_kept", F.lit(scan).alias("valid_from"), F.lit(1).alias("_side")))
    met = both.groupBy(*CONNECTION_KEY).agg(
        F.expr("max(CASE WHEN _side = 0 THEN struct(_kept, valid_from) END) AS _old"),
        F.expr("max(CASE WHEN _side = 1 THEN struct(_kept, valid_from) END) AS _new"),
    ).join(looked, "workspace_id", "left")
    # What is there before and after: the old one as it is, ended, or ended and begun anew.
    old = "struct(_old._kept AS k, _old.valid_from AS f, CAST(NULL AS string) AS t)"
    ended = f"struct(_old._kept AS k, _old.valid_from AS f, {_quoted(scan)} AS t)"
    new = "struct(_new._kept AS k, _new.valid_from AS f, CAST(NULL AS string) AS t)"
    then = (
        f"CASE WHEN _old IS NULL THEN array({new}) WHEN _looked IS NULL OR _old._kept <=> _new._kept THEN array({old}) "
        f"WHEN _new IS NULL THEN array({ended}) ELSE array({ended}, {new}) END"
    )
    return met.selectExpr(*CONNECTION_KEY, f"explode({then}) AS i").selectExpr(
        *CONNECTION_KEY, "i.k.*", "i.f AS valid_from", "i.t AS valid_to"
    ).select(*INTERVAL_COLUMNS)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def valid_at(intervals: DataFrame, scan: str | Column) -> DataFrame:
    """The connections that were there at ``scan``: the inventory as it was then."""
    at = F.lit(scan) if isinstance(scan, str) else scan
    return intervals.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def appeared(intervals: DataFrame, after: str, until: str) -> DataFrame:
    """Connections that are new in ``(after, until]``: there at some scan in it, at none before it. For alerts."""
    first = intervals.groupBy(*CONNECTION_KEY).agg(F.min("valid_from").alias("first_seen"))
    return first.filter((F.col("first_seen") > after) & (F.col("first_seen") <= until))
