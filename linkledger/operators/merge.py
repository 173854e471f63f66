"""Normalising, de-duplicating, merging and comparing connection tables.

Every operation here is one aggregation on the connection key. The aggregate combines
before the shuffle, so even a key whose copies make up a large share of the table sends
at most one row per task, and nulls in the key compare equal as grouping defines it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.functions import scalars as X
from linkledger.schemas import CONNECTION_KEY


def normalise(rows: DataFrame) -> DataFrame:
    """Lower-case the connector; null becomes ``unknown``."""
    return rows.withColumn("connector", F.expr(X.lower_or_unknown("connector")))


def _survivors(rows: DataFrame, order: list[str]) -> DataFrame:
    columns = rows.columns
    rest = [c for c in columns if c not in CONNECTION_KEY and c not in order]
    kept = rows.groupBy(*CONNECTION_KEY).agg(F.expr(f"min(struct({', '.join(order + rest)})) AS _kept"))
    return kept.selectExpr(*[c if c in CONNECTION_KEY else f"_kept.{c} AS {c}" for c in columns if c != "_rank"])


#: Rows of a workspace from which on they are dealt by the whole key.
HOT = 1_000_000


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks by workspace, which the connection key begins with: aggregating by the key needs no other shuffle.

    Rows of a workspace repeat its texts, so they compress several times better side by side than dealt by the whole key. The
    number of tasks is given, as packing tasks by compressed size would make them larger than they can sort in memory.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "workspace_id")


def by_workspace(operate: Callable[..., DataFrame], *stored: DataFrame) -> DataFrame:
    """``operate`` on stored rows dealt by workspace; those of workspaces with more than ``HOT`` rows apart, not dealt.

    Workspaces are counted first, so ``stored`` is to be what can be read again cheaply. No more of them are told to the driver than
    there are millions of rows.
    """
    ids = reduce(DataFrame.unionByName, [rows.select("workspace_id") for rows in stored])
    many = ids.groupBy("workspace_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT)
    found = many.collect()
    if not found:
        return operate(*[dealt(rows) for rows in stored])
    hot = reduce(lambda a, b: a | b, [F.col("workspace_id").eqNullSafe(r[0]) for r in found])
    cold = operate(*[dealt(rows.filter(~hot)) for rows in stored])
    return cold.unionByName(operate(*[rows.filter(hot) for rows in stored]))


def dedup(rows: DataFrame) -> DataFrame:
    """One row per connection key.

    The survivor is the smallest of the copies in column order, nulls first, so the
    result does not depend on file or task order.
    """
    return _survivors(normalise(rows), [])


def merge(existing: DataFrame, incoming: DataFrame, keep: str = "incoming") -> DataFrame:
    """Union by name, one row per key; ``keep`` says which side wins a shared key."""
    if keep not in ("incoming", "existing"):
        raise ValueError("keep must be 'incoming' or 'existing'")
    rank = {"existing": 0 if keep == "existing" else 1, "incoming": 0 if keep == "incoming" else 1}
    both = normalise(existing).withColumn("_rank", F.lit(rank["existing"])).unionByName(
        normalise(incoming).withColumn("_rank", F.lit(rank["incoming"])), allowMissingColumns=True
    )
    return _survivors(both, ["_rank"])


def merge_all(parts: list[DataFrame], keep: str = "last") -> DataFrame:
    """Merge chunks of one scan in a single aggregation instead of one rewrite per chunk."""
    tagged = None
    for i, part in enumerate(parts):
        rank = -i if keep == "last" else i
        part = normalise(part).withColumn("_rank", F.lit(rank))
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    return _survivors(tagged, ["_rank"])


def latest(rows: DataFrame, sequence: str) -> DataFrame:
    """One row per key, from the highest ``sequence`` it occurs with."""
    ranked = normalise(rows).withColumn("_rank", -F.col(sequence)).drop(sequence)
    return _survivors(ranked, ["_rank"])


def replace_scanned(existing: DataFrame, incoming: DataFrame, scanned: DataFrame) -> DataFrame:
    """Like :func:`merge`, but connections gone from the scanned workspaces are removed.

    ``scanned`` holds the ``workspace_id`` of every workspace in the scan, also of those
    that returned nothing.
    """
    untouched = existing.join(scanned.select("workspace_id").distinct(), "workspace_id", "left_anti")
    return merge(untouched.select(*existing.columns), incoming)


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys present on one side only, with ``change`` = ``added`` or ``removed``."""
    old = normalise(before).selectExpr(*CONNECTION_KEY, "1 AS _before", "0 AS _after")
    new = normalise(after).selectExpr(*CONNECTION_KEY, "0 AS _before", "1 AS _after")
    seen = old.unionByName(new).groupBy(*CONNECTION_KEY).agg(F.max("_before").alias("_before"), F.max("_after").alias("_after"))
    return seen.filter("_before <> _after").selectExpr(
        *CONNECTION_KEY, "CASE WHEN _after = 1 THEN 'added' ELSE 'removed' END AS change"
    )


def duplicates(rows: DataFrame) -> DataFrame:
    """Connection keys that occur more than once; empty after :func:`dedup`."""
    return rows.groupBy(*CONNECTION_KEY).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
