"""Workspace fingerprints: content hashes that tell whether connections changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X
from linkledger.schemas import FINGERPRINT_COLUMNS

FIELDS = ["connector", "server", "database", "endpoint"]
#: Lanes of 32 bits that a digest is summed in: sums of up to 2^31 connections are exact in 64 bits.
LANES = 8


def _canonical(fields: list[str]) -> str:
    """One connection as a JSON object with sorted keys."""
    parts = [f"'\"{name}\": ', {X.json_string(name)}" for name in sorted(fields)]
    return "concat('{', " + ", ', ', ".join(parts) + ", '}')"


_SORT_KEY = "concat(" + ", '_', ".join(f"coalesce({c}, 'None')" for c in ("connector", "server", "database")) + ")"


def connection_hashes(rows: DataFrame, include_item_id: bool = False, as_list: bool = False) -> DataFrame:
    """``(workspace_id, connection_hash)`` for every workspace that has rows.

    Every connection is a JSON object; the hash is SHA-256 of the number of connections and
    the sums of the eight 32-bit lanes of their digests. Sums combine in any order and before
    the shuffle, so a workspace is never gathered, whatever its size, and repeated
    connections count as often as they occur.

    ``as_list`` gives SHA-256 of the connections as one sorted JSON list instead, byte for
    byte as other tools store it; that gathers each workspace in one row.
    """
    fields = FIELDS + (["item_id"] if include_item_id else [])
    kept = rows.filter(X.is_filled("workspace_id"))
    return _listed(kept, fields) if as_list else _summed(kept, fields)


def _listed(rows: DataFrame, fields: list[str]) -> DataFrame:
    counted = rows.groupBy("workspace_id", *fields).agg(F.expr("count(1) AS n"))
    docs = counted.selectExpr("workspace_id", f"{_SORT_KEY} AS k", f"{_canonical(fields)} AS doc", "n")
    return docs.groupBy("workspace_id").agg(
        F.expr("array_sort(collect_list(struct(k, doc, n))) AS docs")
    ).selectExpr(
        "workspace_id",
        "sha2(concat('[', array_join(flatten(transform(docs, x -> array_repeat(x.doc, CAST(x.n AS int)))), ', '), "
        "']'), 256) AS connection_hash",
    )


def lane_sums(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """``n`` and ``lane0`` up, the sums of the digests' lanes, by ``keys``."""
    digests = rows.selectExpr(*keys, f"sha2({_canonical(fields)}, 256) AS d")
    lanes = [F.expr(f"sum(CAST(conv(substring(d, {1 + 8 * i}, 8), 16, 10) AS bigint)) AS lane{i}") for i in range(LANES)]
    return digests.groupBy(*keys).agg(F.expr("count(1) AS n"), *lanes)


def hash_of_sums() -> str:
    return f"sha2(concat_ws(':', n, {', '.join(f'lane{i}' for i in range(LANES))}), 256)"


def _summed(rows: DataFrame, fields: list[str]) -> DataFrame:
    return lane_sums(rows, ["workspace_id"], fields).selectExpr("workspace_id", f"{hash_of_sums()} AS connection_hash")


def fingerprints(
    rows: DataFrame,
    workspaces: DataFrame,
    scan_time: str | Column,
    include_empty: bool = False,
    **options,
) -> DataFrame:
    """Fingerprint rows. ``workspaces`` holds ``id, name, type``, one row per workspace.

    ``include_empty`` also covers workspaces without connections, whose hash is that of
    the empty string.
    """
    hashes = connection_hashes(rows, **options)
    meta = workspaces.select(
        F.col("id").alias("workspace_id"), F.col("name").alias("_name"), F.lower("type").alias("_type")
    )
    joined = hashes.join(meta, "workspace_id", "full_outer" if include_empty else "left")
    if include_empty:
        joined = joined.filter(X.is_filled("workspace_id"))
    when = F.lit(scan_time) if isinstance(scan_time, str) else scan_time
    return joined.select(
        "workspace_id",
        F.coalesce("_name", F.lit("")).alias("workspace_name"),
        F.coalesce("_type", F.lit("")).alias("workspace_type"),
        F.coalesce("connection_hash", F.sha2(F.lit(""), 256)).alias("connection_hash"),
        when.alias("last_scan_time"),
    )


def upsert(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored fingerprints updated by new ones; a null in the new row keeps the old value."""
    old, upd = stored.alias("old"), new.alias("new")
    joined = old.join(upd, "workspace_id", "full_outer")
    return joined.select(
        "workspace_id",
        *[F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in FINGERPRINT_COLUMNS[1:]],
    )


def diff(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Per workspace: ``new``, ``changed``, ``unchanged`` or ``absent`` (not in the scan)."""
    old = stored.select("workspace_id", F.col("connection_hash").alias("stored_hash"), F.lit(True).alias("_old"))
    cur = current.select("workspace_id", F.col("connection_hash").alias("current_hash"), F.lit(True).alias("_cur"))
    joined = old.join(cur, "workspace_id", "full_outer")
    status = (
        F.when(F.col("_old").isNull(), F.lit("new"))
        .when(F.col("_cur").isNull(), F.lit("absent"))
        .when(F.col("stored_hash").eqNullSafe(F.col("current_hash")), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return joined.select("workspace_id", "stored_hash", "current_hash", status.alias("status"))


def _recently_scanned(stored: DataFrame, as_of: Column, hours: float) -> DataFrame:
    cutoff = as_of - F.make_dt_interval(secs=F.lit(float(hours) * 3600))
    return stored.filter(F.try_to_timestamp("last_scan_time") > cutoff).select("workspace_id").distinct()


def skip_recent(
    candidates: DataFrame,
    stored: DataFrame,
    as_of: Column,
    hours: float = V.RECENT_HOURS,
    min_candidates: int = 0,
) -> DataFrame:
    """Candidates (``workspace_id``) not scanned within the last ``hours``.

    Missing or unreadable times keep the workspace. ``min_candidates`` re-scans everything
    while there are that many candidates or fewer.
    """
    recent = _recently_scanned(stored, as_of, hours)
    if min_candidates:
        enough = (
            candidates.select("workspace_id").limit(min_candidates + 1)
            .agg((F.count(F.lit(1)) > min_candidates).alias("enough")).scalar()
        )
        recent = recent.filter(enough)
    return candidates.join(recent, "workspace_id", "left_anti")


def skip_reduction(
    candidates: DataFrame, stored: DataFrame, as_of: Column, hours: float = V.RECENT_HOURS,
    min_candidates: int = 0,
) -> DataFrame:
    """How many candidates the recency test skips, and the share in percent."""
    recent = _recently_scanned(stored, as_of, hours).withColumn("_recent", F.lit(True))
    joined = candidates.join(recent, "workspace_id", "left")
    counts = joined.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("_recent")).alias("recent"))
    skipped = F.when(F.col("candidates") > min_candidates, F.col("recent")).otherwise(F.lit(0).cast("long"))
    return counts.select("candidates", skipped.alias("skipped")).select(
        "candidates", "skipped",
        (F.col("candidates") - F.col("skipped")).alias("to_scan"),
        F.when(F.col("candidates") > 0, F.round(F.col("skipped") * 100.0 / F.col("candidates"), 4))
        .otherwise(F.lit(0.0)).alias("reduction_pct"),
    )
