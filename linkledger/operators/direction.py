"""Connection direction as a plain expression over connector, server and endpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X


def direction(connector: str = "connector", server: str = "server", endpoint: str = "endpoint") -> str:
    """``outbound``, ``internal`` or ``unknown``; the connector decides before the address."""
    con, srv, end = (f"lower(coalesce({c}, ''))" for c in (connector, server, endpoint))
    external = f"({X.contains_any(srv, V.EXTERNAL_DOMAINS)} OR {X.contains_any(end, V.EXTERNAL_DOMAINS)})"
    return (
        f"CASE WHEN {X.contains_any(con, V.OUTBOUND_CONNECTOR_PARTS)} THEN 'outbound' "
        f"WHEN {X.contains_any(con, V.INTERNAL_CONNECTOR_PARTS)} THEN 'internal' "
        f"WHEN {external} AND NOT {X.contains_any(srv, V.INTERNAL_SERVER_PARTS)} THEN 'outbound' "
        "ELSE 'unknown' END"
    )


def classify(rows: DataFrame) -> DataFrame:
    """Add the ``direction`` column."""
    return rows.withColumn("direction", F.expr(direction()))


def direction_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("direction").agg(F.expr("count(1) AS connection_count"))
