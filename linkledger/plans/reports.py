"""Ready reports over the connection inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V
from linkledger.operators import merge as M
from linkledger.schemas import CONNECTION_KEY


def _count():
    return F.count(F.lit(1))


def _in_order(rows: DataFrame, column: str) -> DataFrame:
    """Sorted by a column and then the connection key, so that equal values of the column spread over tasks."""
    return rows.orderBy(column, *[F.asc_nulls_first(k) for k in CONNECTION_KEY if k != column])


def connector_counts(inv: DataFrame, cloud_only: bool = False) -> DataFrame:
    rows = inv.filter("cloud") if cloud_only else inv
    return rows.groupBy("connector").agg(_count().alias("connection_count")).orderBy(
        F.desc("connection_count"), "connector"
    )


def connector_summary(inv: DataFrame) -> DataFrame:
    """Per connector: distinct workspaces and connections.

    Counting per workspace first keeps a dominant connector from meeting in one task.
    """
    per_ws = inv.groupBy("connector", "workspace_id").agg(_count().alias("n"))
    return per_ws.groupBy("connector").agg(
        F.count("workspace_id").alias("workspace_count"), F.sum("n").alias("connection_count")
    ).orderBy(F.desc("connection_count"), "connector")


def owner_summary(inv: DataFrame) -> DataFrame:
    """Per owner list: connections and distinct connectors."""
    per_connector = inv.filter(F.col("workspace_users").isNotNull()).groupBy("workspace_users", "connector").agg(
        _count().alias("n")
    )
    return per_connector.groupBy("workspace_users").agg(
        F.sum("n").alias("connection_count"), F.count("connector").alias("unique_connectors")
    ).orderBy(F.desc("connection_count"), "workspace_users")


def workspace_connections_top(inv: DataFrame, n: int = 20) -> DataFrame:
    keys = ["workspace_name", "connector", "server", "database"]
    return inv.groupBy(*keys).agg(_count().alias("connection_count")).orderBy(
        F.desc("connection_count"), *[F.asc_nulls_first(k) for k in keys]
    ).limit(n)


def totals(inv: DataFrame) -> DataFrame:
    """Rows, distinct workspaces and the latest item modification."""
    per_ws = inv.groupBy("workspace_id").agg(_count().alias("n"), F.max("item_modified_date").alias("latest"))
    return per_ws.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("workspace_id").alias("workspaces_scanned"),
        F.max("latest").alias("latest_modified"),
    )


def cloud_with_owners(inv: DataFrame) -> DataFrame:
    return _in_order(inv.filter("cloud"), "workspace_name").select(
        "connector", "target", "workspace_name", "workspace_users", "item_name"
    )


def cloud_by_connector(inv: DataFrame) -> DataFrame:
    return _in_order(inv.filter("cloud"), "connector").select(
        "connector", "target", "workspace_name", "item_name", "item_type"
    )


def of_connectors(inv: DataFrame, connectors: list[str]) -> DataFrame:
    return inv.filter(F.col("connector").isin(*connectors)).transform(_in_order, "workspace_name")


def by_owner(inv: DataFrame, owner: str) -> DataFrame:
    return inv.filter(F.col("workspace_users").contains(owner)).select(
        "connector", "target", "workspace_name", "item_name"
    )


def recently_modified(inv: DataFrame, n: int = 20) -> DataFrame:
    """Latest modified items; the connection key breaks ties."""
    return (
        inv.filter(F.col("item_modified_date").isNotNull())
        .orderBy(F.desc("item_modified_date"), *[F.asc_nulls_first(k) for k in CONNECTION_KEY])
        .limit(n)
        .select("item_name", "item_modified_by", "item_modified_date", "connector", "target")
    )


def redacted(inv: DataFrame) -> DataFrame:
    """Counts per connector with the sensitive columns blanked out."""
    return inv.groupBy("connector").agg(_count().alias("connection_count")).select(
        "connector", F.lit("REDACTED").alias("server"), F.lit("REDACTED").alias("workspace_users"), "connection_count"
    )


def workspace_inventory(inv: DataFrame, include_personal: bool = False) -> DataFrame:
    """Workspace list derived from the inventory, in the source-table shape."""
    rows = inv.select(
        "workspace_id", "workspace_name", F.col("workspace_kind").alias("workspace_type"), "capacity_id"
    )
    if not include_personal:
        personal = F.lower("workspace_type") == V.PERSONAL_TYPE.lower()
        rows = rows.filter(~F.coalesce(personal, F.lit(False)))
    return rows.distinct()


def distinct_connections(inv: DataFrame) -> DataFrame:
    rows = inv.select(
        *CONNECTION_KEY, "workspace_name", "workspace_kind", "workspace_users", "item_name", "item_type",
        "item_creator", "item_modified_by", "item_modified_date", "target", "connection_scope", "cloud", "generation",
    )
    return M.by_workspace(DataFrame.distinct, rows)


def production_only(workspaces: DataFrame) -> DataFrame:
    """Workspaces not named after test or development, and not personal."""
    name, type_ = F.col("workspace_name"), F.lower("workspace_type")
    return workspaces.filter(
        ~name.contains("Test") & ~name.contains("Dev") & (type_ != V.PERSONAL_TYPE.lower())
    )


def on_capacities(workspaces: DataFrame, excluded_types: list[str], capacities: list[str]) -> DataFrame:
    return workspaces.filter(
        ~F.lower("workspace_type").isin(*[t.lower() for t in excluded_types]) & F.col("capacity_id").isin(*capacities)
    )
