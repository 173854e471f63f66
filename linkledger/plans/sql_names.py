"""Rules and reports under names that SQL knows.

The functions are SQL themselves: Spark puts their text in place, so a query with them is planned like the same
query without. They belong to the session; the inventory they report on is the view or table they are registered for.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from linkledger.functions import scalars as X
from linkledger.operators import direction as D
from linkledger.sinks.tables import check_identifier

#: Rules: name, parameters, result, text.
RULES = [
    ("connection_direction", "connector STRING, server STRING, endpoint STRING", "STRING", D.direction()),
    ("connection_target", "server STRING, database STRING, endpoint STRING", "STRING", X.build_target("server", "database", "endpoint")),
    ("is_cloud_connection", "connection_scope STRING, connector STRING", "BOOLEAN", X.cloud_flag("connection_scope", "connector")),
]
#: Reports on the inventory: name, parameters, columns, text.
REPORTS = [
    ("connector_counts", "only_cloud BOOLEAN", "connector STRING, connection_count BIGINT",
     "SELECT connector, count(1) FROM {inventory} WHERE cloud OR NOT only_cloud GROUP BY connector"),
    ("connections_of_owner", "owner STRING", "connector STRING, target STRING, workspace_name STRING, item_name STRING",
     "SELECT connector, target, workspace_name, item_name FROM {inventory} WHERE contains(workspace_users, owner)"),
    ("connections_by_direction", "wanted STRING", "workspace_id STRING, item_id STRING, connector STRING, server STRING, database STRING, endpoint STRING",
     "SELECT workspace_id, item_id, connector, server, database, endpoint FROM {inventory} "
     f"WHERE {D.direction()} = wanted"),
]


def register_rules(spark: SparkSession) -> None:
    """The rules as temporary functions of the session."""
    for name, parameters, result, text in RULES:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {text}")


def register_reports(spark: SparkSession, inventory: str) -> None:
    """The reports as temporary table functions on ``inventory``, a table or view."""
    check_identifier(inventory, "table name")
    for name, parameters, columns, text in REPORTS:
        body = text.format(inventory=inventory)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body}")
