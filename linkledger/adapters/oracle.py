"""ANSI SQL for the registered queries, written against the raw tables.

The SQL joins the tables directly and knows nothing of JSON, so an equal result shows
that the detour over payload documents loses nothing.
"""

from __future__ import annotations

_KEY = "workspace_id, item_id, connector, server, database, endpoint"
_REST = (
    "workspace_name, workspace_kind, workspace_users, capacity_id, capacity_name, is_dedicated_capacity, "
    "item_name, item_type, item_creator, item_modified_by, item_modified_date, target, connection_scope, cloud, "
    "generation"
)
_COLUMNS = f"{_KEY}, {_REST}"
_REST_ORDER = ", ".join(f"{c.strip()} NULLS FIRST" for c in _REST.split(","))

_CONNECTORS = (
    "['AzureSqlDatabase','Snowflake','Salesforce','SharePointOnline','Dynamics365','REST','Web','S3','Oracle',"
    "'MySQL','PostgreSQL','Kusto','Synapse','OneLake','FabricLakehouse','Lakehouse','ADLS','ABFSS','SqlServerless',"
    "'Sql','File','Folder','Odbc',NULL,'']"
)
_CLOUD = (
    "('azuresqldatabase','sqlserverless','synapse','kusto','onelake','adls','abfss','s3','rest',"
    "'sharepointonline','dynamics365','salesforce','snowflake','fabriclakehouse')"
)

_WS = """
usr AS (
  SELECT s_suppkey // 12 AS g, s_suppkey AS s,
         CASE WHEN s_suppkey % 7 <> 0 THEN 'user' || s_suppkey || '@example.org' ELSE 'id-' || s_suppkey END AS addr
  FROM supplier WHERE s_suppkey % 3 IN (0, 1)),
own AS (
  SELECT g, string_agg(addr, ', ' ORDER BY s) AS users FROM usr GROUP BY g),
ws AS (
  SELECT c_custkey AS custkey, 'ws-' || c_custkey AS id,
         c_name || CASE c_custkey % 10 WHEN 3 THEN ' Test' WHEN 7 THEN ' Dev' ELSE '' END AS name,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN 'PersonalGroup'
              ELSE 'Workspace' END AS type,
         CASE WHEN c_nationkey % 5 <> 0 THEN 'cap-' || lpad(CAST(c_nationkey AS VARCHAR), 8, '0') END AS cap_id,
         CASE WHEN c_custkey % 2 = 0 THEN n_name END AS cap_name,
         (c_nationkey % 5 <> 0 AND c_nationkey % 7 <> 1) AS dedicated,
         TIMESTAMP '2024-01-31 00:00:00' - to_hours(CAST(c_custkey % 97 AS INTEGER)) AS modified,
         own.users
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN own ON c_custkey // 180 = own.g),
side AS (
  SELECT custkey, id AS workspace_id, name, lower(coalesce(type, 'unknown')) AS kind, users,
         cap_id AS capacity_id,
         CASE WHEN NOT dedicated OR cap_id IS NULL THEN 'Shared'
              ELSE coalesce(cap_name, 'Capacity_' || substr(cap_id, 1, 8)) END AS capacity_name,
         dedicated AS is_dedicated_capacity
  FROM ws),
meta AS (
  SELECT custkey, workspace_id, name AS workspace_name, kind AS workspace_kind,
         CASE WHEN custkey % 13 <> 5 THEN users END AS workspace_users,
         CASE WHEN custkey % 13 <> 5 THEN capacity_id END AS capacity_id,
         CASE WHEN custkey % 13 <> 5 THEN capacity_name ELSE 'Shared' END AS capacity_name,
         custkey % 13 <> 5 AND is_dedicated_capacity AS is_dedicated_capacity
  FROM side)"""

_ITEMS = """
it AS (
  SELECT o_custkey AS custkey, o_orderkey AS k, o_orderdate AS item_date,
         'it-' || o_orderkey AS item_id, 'item ' || o_orderkey AS item_name,
         substr(o_orderpriority, 1, 1) AS p,
         CASE substr(o_orderpriority, 1, 1)
              WHEN '1' THEN CASE WHEN o_orderkey % 4 = 1 THEN 'dataset' ELSE 'semanticmodel' END
              WHEN '2' THEN 'dataflow' WHEN '3' THEN 'pipeline'
              WHEN '4' THEN CASE WHEN o_orderstatus = 'F' THEN 'lakehouse' ELSE 'notebook' END
              ELSE CASE WHEN o_orderkey % 6 <> 5 THEN 'report' ELSE 'unknown' END END AS kind,
         CASE WHEN o_orderkey % 3 = 2 THEN 'u' || (o_orderkey % 50) ELSE 'cfg' || (o_orderkey % 20) END AS item_creator,
         'm' || (o_orderkey % 30) AS item_modified_by,
         CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS item_modified_date,
         CASE WHEN substr(o_orderpriority, 1, 1) = '2' THEN
              CASE WHEN o_orderkey % 2 = 0 THEN '2' WHEN o_orderkey % 4 = 1 THEN '1' END END AS generation
  FROM orders),
ref AS (
  SELECT l_orderkey AS k, l_shipdate AS ship_date, l_linenumber AS n, l_returnflag AS rf, l_linestatus AS ls,
         list_extract(__CONNECTORS__, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER)) AS con,
         'Provider' || (CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) % 3) AS provider,
         CASE l_suppkey % 4 WHEN 0 THEN 'srv' || (l_suppkey % 10) || '.database.windows.net'
              WHEN 1 THEN 'onelake' || (l_suppkey % 10) || '.windows.net'
              WHEN 2 THEN 'host' || (l_suppkey % 10) || '.corp.local'
              ELSE CASE WHEN l_suppkey % 8 = 3 THEN 'gw' || (l_suppkey % 10) || '.snowflakecomputing.com' END
         END AS srv,
         CASE WHEN p_size % 5 <> 0 THEN 'db' || (p_size % 5) WHEN p_size % 10 = 0 THEN 'legacy' END AS db,
         CASE WHEN l_linenumber % 4 <> 0 THEN 'https://h' || (l_suppkey % 10)
              || CASE WHEN l_suppkey % 6 = 5 THEN '.azure.com/' ELSE '.example/' END || (l_partkey % 5) END AS url,
         '/p/' || (l_partkey % 5) AS other
  FROM lineitem JOIN part ON l_partkey = p_partkey),
raw AS (
  SELECT it.*, ship_date AS dated,
         CASE WHEN p = '2' THEN coalesce(lower(coalesce(nullif(con, ''), provider)), 'unknown')
              ELSE coalesce(lower(con), 'unknown') END AS connector,
         CASE WHEN p = '1' THEN srv END AS server,
         CASE WHEN p = '1' THEN db END AS database,
         CASE WHEN p IN ('2', '4') THEN coalesce(url, other)
              WHEN p = '3' AND n % 5 <> 0 THEN coalesce(url, other) END AS endpoint,
         CASE WHEN p = '1' THEN rf <> 'A' WHEN p = '2' THEN true
              WHEN p = '3' THEN n % 5 = 0 OR rf <> 'A'
              WHEN n % 3 = 1 THEN ls = 'O' WHEN n % 3 = 2 THEN rf <> 'R' ELSE true END AS in_cloud
  FROM it JOIN ref USING (k) WHERE p <> '5'
  UNION ALL
  SELECT it.*, item_date AS dated, 'unknown', NULL, NULL, NULL, true FROM it WHERE p = '5'),
conn AS (
  SELECT workspace_id, workspace_name, workspace_kind, workspace_users, capacity_id, capacity_name,
         is_dedicated_capacity, item_id, item_name, kind, dated, raw.k,
         CASE p WHEN '1' THEN 'SemanticModel' ELSE upper(substr(kind, 1, 1)) || substr(kind, 2) END AS item_type,
         item_creator, item_modified_by, item_modified_date, connector,
         nullif(concat_ws(' | ', 'Server: ' || nullif(server, ''), 'Database: ' || nullif(database, ''),
                          'Endpoint: ' || nullif(endpoint, '')), '') AS target,
         server, database, endpoint,
         CASE WHEN in_cloud THEN 'Cloud' ELSE 'OnPremViaGateway' END AS connection_scope,
         (in_cloud OR connector IN __CLOUD__) AS cloud, generation
  FROM raw JOIN meta USING (custkey))""".replace("__CONNECTORS__", _CONNECTORS).replace("__CLOUD__", _CLOUD)


def _best(source: str, order: str = "") -> str:
    """One row per key, the first in ``order`` and then in column order."""
    lead = f"{order}, " if order else ""
    return (
        f"SELECT {_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} "
        f"ORDER BY {lead}{_REST_ORDER}) AS pick FROM {source}) WHERE pick = 1"
    )


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _conn(select: str, *more: str) -> str:
    return _with(_WS, _ITEMS, *more, select=select)


_INV = f"inv AS ({_best('conn')})"


def _inv(select: str, *more: str) -> str:
    return _conn(select, _INV, *more)


_EXISTING = "existing AS (SELECT * FROM conn WHERE dated < TIMESTAMP '1999-01-01')"
_INCOMING = (
    "incoming AS (SELECT * REPLACE (item_name || ' v2' AS item_name) FROM conn WHERE dated >= TIMESTAMP '1998-01-01')"
)
_BOTH = (
    f"both_sides AS (SELECT {_COLUMNS}, 0 AS side FROM existing UNION ALL SELECT {_COLUMNS}, 1 AS side FROM incoming)"
)


def _hashes(name: str, condition: str) -> str:
    """Workspace hashes of the connections that meet a condition."""
    def text(c: str) -> str:
        return f"coalesce('\"' || {c} || '\"', 'null')"

    doc = (
        "'{\"connector\": ' || " + text("connector") + " || ', \"database\": ' || " + text("database")
        + " || ', \"endpoint\": ' || " + text("endpoint") + " || ', \"server\": ' || " + text("server") + " || '}'"
    )
    lanes = ", ':', ".join(
        f"CAST(sum(CAST(('0x' || substr(d, {1 + 8 * i}, 8)) AS UBIGINT)) AS VARCHAR)" for i in range(8)
    )
    return (
        f"{name} AS (SELECT workspace_id, sha256(concat(count(*), ':', {lanes})) AS connection_hash "
        f"FROM (SELECT workspace_id, sha256({doc}) AS d FROM conn WHERE {condition}) GROUP BY workspace_id)"
    )


_STORED_HASH = _hashes("old_hash", "dated < TIMESTAMP '2001-10-01'")
_CURRENT_HASH = _hashes("new_hash", "dated >= TIMESTAMP '1995-02-01'")
_FULL_HASH = _hashes("new_hash", "true")


def _prints(source: str, time: str) -> str:
    return (
        f"SELECT workspace_id, coalesce(ws.name, '') AS workspace_name, coalesce(lower(ws.type), '') AS workspace_type, "
        f"connection_hash, '{time}' AS last_scan_time FROM {source} LEFT JOIN ws ON ws.id = workspace_id"
    )


def _upserted() -> str:
    return (
        "SELECT coalesce(n.workspace_id, o.workspace_id) AS workspace_id, "
        + ", ".join(
            f"coalesce(n.{c}, o.{c}) AS {c}"
            for c in ("workspace_name", "workspace_type", "connection_hash", "last_scan_time")
        )
        + f" FROM ({_prints('old_hash', '2024-01-30T00:00:00+00:00')}) o"
        + f" FULL OUTER JOIN ({_prints('new_hash', '2024-01-31T00:00:00+00:00')}) n USING (workspace_id)"
    )


_RECENT = """
recent AS (
  SELECT 'ws-' || c_custkey AS workspace_id FROM customer
  WHERE c_acctbal >= 2500 AND c_custkey % 29 <> 0 AND c_custkey % 31 <> 0 AND c_custkey % 48 < 24)"""
_CAND = """
cand AS (SELECT id AS workspace_id FROM ws WHERE modified >= TIMESTAMP '2024-01-28 00:00:00')"""

_TODO = """
todo AS (
  SELECT id AS workspace_id FROM ws WHERE modified >= TIMESTAMP '2024-01-29 00:00:00'
  AND coalesce(type, '') <> 'PersonalGroup' AND id NOT IN (SELECT workspace_id FROM recent))"""
# Connections that the second scan no longer has.
_GONE = "CAST(substr(workspace_id, 4) AS BIGINT) % 2 = 0 AND (CAST(substr(workspace_id, 4) AS BIGINT) % 10 = 0 OR k % 3 = 0)"

_EVENTS = """
ev AS (
  SELECT CASE event_type WHEN 'view' THEN 'ViewReport' WHEN 'click' THEN 'GetDataset' WHEN 'purchase' THEN
              'ExecuteQueries' WHEN 'error' THEN 'ExportReport' ELSE 'CreateDataset' END AS "Activity",
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "CreationTime",
         CASE WHEN user_id % 19 <> 0 THEN 'user' || user_id END AS "UserId",
         '10.0.' || (user_id % 7) || '.' || (k % 16) AS "ClientIP",
         CASE k % 4 WHEN 0 THEN 'Mozilla/5.0' WHEN 1 THEN '' WHEN 3 THEN 'python-requests/2.31' END AS "UserAgent",
         CASE WHEN user_id % 5 <> 0 THEN 'ws-' || (user_id % 40) END AS "WorkspaceId",
         'Workspace ' || (user_id % 40) AS "WorkspaceName",
         CASE WHEN event_type IN ('click', 'purchase') THEN 'ds-' || k END AS "DatasetId",
         CASE WHEN event_type IN ('click', 'purchase') THEN 'Dataset ' || k END AS "DatasetName",
         CASE WHEN event_type IN ('view', 'error') THEN 'rp-' || k END AS "ReportId",
         CASE WHEN event_type IN ('view', 'error') THEN 'Report ' || k END AS "ReportName",
         CASE event_type WHEN 'error' THEN false WHEN 'view' THEN true END AS "IsSuccess", ts
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)),
inb AS (
  SELECT "CreationTime" AS "timestamp", "Activity" AS activity, "UserId" AS "user", "ClientIP" AS client_ip,
         "UserAgent" AS user_agent, "WorkspaceId" AS workspace_id, "WorkspaceName" AS workspace_name,
         "DatasetId" AS dataset_id, "DatasetName" AS dataset_name, "ReportId" AS report_id,
         "ReportName" AS report_name, coalesce("IsSuccess", true) AS is_success
  FROM ev WHERE "Activity" IN ('GetDataset', 'ExecuteQueries', 'AnalyzeInExcel', 'ExportReport', 'ViewReport',
        'GetTile', 'GenerateEmbedToken', 'GetDashboard')
    AND "UserAgent" <> '' AND NOT starts_with("UserAgent", 'Mozilla')
    AND ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00')"""


def _any(column: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


_OUT = ["snowflake", "salesforce", "dynamics365", "rest", "web", "azuresqldatabase", "s3", "oracle", "mysql",
        "postgresql", "sharepoint", "kusto", "synapse"]
_IN = ["onelake", "fabriclakehouse", "lakehouse"]
_DOMAINS = [".windows.net", ".snowflakecomputing.com", ".salesforce.com", ".dynamics.com", ".azure.com"]
_S, _E, _C = (f"lower(coalesce({c}, ''))" for c in ("server", "endpoint", "connector"))
_DIRECTION = (
    f"CASE WHEN {_any(_C, _OUT)} THEN 'outbound' WHEN {_any(_C, _IN)} THEN 'internal' "
    f"WHEN ({_any(_S, _DOMAINS)} OR {_any(_E, _DOMAINS)}) AND NOT {_any(_S, ['onelake', 'fabric'])} THEN 'outbound' "
    "ELSE 'unknown' END"
)

_KEYED = "keyed AS (SELECT *, CASE WHEN cap_id IS NOT NULL AND dedicated THEN cap_id ELSE 'shared' END AS capacity_key FROM ws)"
_PLAN = """
plan AS (
  SELECT id, seq, CAST(seq // 100 AS INTEGER) AS batch_no, CAST(seq // 400 AS INTEGER) AS chunk_no
  FROM (SELECT id, row_number() OVER (ORDER BY substr(md5(id), 1, 3), id) - 1 AS seq FROM ws))"""
_CAP_PLAN = """
plan AS (
  SELECT id, capacity_key, seq, CAST(seq // 10 AS INTEGER) AS batch_no, CAST(seq // 40 AS INTEGER) AS chunk_no
  FROM (SELECT id, capacity_key,
               row_number() OVER (PARTITION BY capacity_key ORDER BY substr(md5(id), 1, 3), id) - 1 AS seq
        FROM keyed))"""
_COMPLETED = """
completed AS (
  SELECT batch_no FROM plan LEFT JOIN recent ON id = workspace_id
  GROUP BY batch_no HAVING count(workspace_id) * 3 >= count(*))"""


def _plan(select: str) -> str:
    return _with(_WS, _RECENT, _PLAN, _COMPLETED, select=select)


_SRC = (
    "src AS (SELECT CASE WHEN custkey % 23 <> 0 THEN id END AS workspace_id, name AS workspace_name, "
    "type AS workspace_type, cap_id AS capacity_id FROM ws)"
)
_NOT_PERSONAL = "coalesce(lower({c}) <> 'personalgroup', true)"
_DOCS = "docs AS (SELECT DISTINCT c_custkey // 100 AS doc FROM customer)"
_SIDE_COLUMNS = "workspace_id, name, kind, users, capacity_id, capacity_name, is_dedicated_capacity"
_RETURNED = f"returned AS (SELECT {_SIDE_COLUMNS} FROM side WHERE custkey IN (SELECT o_custkey FROM orders))"
_LOG = (
    "log AS (SELECT ts, CASE WHEN event_type = 'error' THEN 429 ELSE 200 END AS status, "
    "strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H') AS hour FROM events)"
)
_INV_WS = (
    "iw AS (SELECT DISTINCT workspace_id, workspace_name, workspace_kind AS workspace_type, capacity_id FROM inv)"
)


def _bare_meta(alias: str) -> str:
    """Columns of a workspace the by-id scan describes: owners, but no capacity."""
    return (
        f"{alias}.* REPLACE (side.users AS workspace_users, NULL AS capacity_id, 'Shared' AS capacity_name, "
        "false AS is_dedicated_capacity)"
    )


_NUMBER = "CAST(substr(workspace_id, 4) AS BIGINT)"
# Three scans: the older connections, then twice the newer ones, of some workspaces only.
_SCANS = f"""
looked AS (
  SELECT workspace_id, '2024-01-29' AS scan FROM side UNION ALL
  SELECT workspace_id, '2024-01-30' FROM side WHERE {_NUMBER} % 2 = 0 UNION ALL
  SELECT workspace_id, '2024-01-31' FROM side WHERE {_NUMBER} % 3 <> 0),
seen AS (SELECT *, row_number() OVER w AS seq, lead(scan) OVER w AS next FROM looked WINDOW w AS (PARTITION BY workspace_id ORDER BY scan)),
found AS (
  SELECT {_COLUMNS}, '2024-01-29' AS scan FROM existing UNION ALL
  SELECT {_COLUMNS}, '2024-01-30' FROM incoming UNION ALL SELECT {_COLUMNS}, '2024-01-31' FROM incoming),
one AS (
  SELECT * EXCLUDE (pick) FROM (
    SELECT *, row_number() OVER (PARTITION BY scan, {_KEY} ORDER BY {_REST_ORDER}) AS pick FROM found JOIN seen USING (workspace_id, scan))
  WHERE pick = 1),
runs AS (SELECT *, seq - row_number() OVER (PARTITION BY {_COLUMNS} ORDER BY seq) AS run FROM one),
hist AS (SELECT {_COLUMNS}, min(scan) AS valid_from, max_by(coalesce(next, '-'), seq) AS until FROM runs GROUP BY {_COLUMNS}, run)"""
_HISTORY = f"SELECT {_COLUMNS}, valid_from, nullif(until, '-') AS valid_to FROM hist"
_SHORT = _EVENTS.replace("TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-01 12:00:00'")


def _item_docs(name: str, condition: str) -> str:
    """The connections of every item as one sorted list."""
    doc = "[connector, coalesce('=' || server, '-'), coalesce('=' || database, '-'), coalesce('=' || endpoint, '-')]"
    return f"{name} AS (SELECT workspace_id, item_id, list_sort(list({doc})) AS l FROM conn WHERE {condition} GROUP BY ALL)"


ORACLE: dict[str, str] = {
    "scan_payload_dir": _conn(_best("conn")),
    "payload_rejects": _with(_DOCS, select="""
        SELECT 'cut-scan-' || doc || '.json' AS path, CAST(NULL AS INTEGER) AS position, 'invalid_json' AS reason,
               CAST(1 AS BIGINT) AS n FROM docs WHERE doc % 7 = 0
        UNION ALL
        SELECT 'scan-' || doc || '.json', 1, 'element_not_object', 1 FROM docs WHERE doc % 8 = 7
        """),
    "payload_root_normalise": _with(_DOCS, select="""
        SELECT 'scan-' || doc || '.json' AS path, doc % 2 = 1 AS is_list, 1 AS payloads FROM docs
        UNION ALL
        SELECT 'cut-scan-' || doc || '.json', doc % 2 = 1, 0 FROM docs WHERE doc % 7 = 0
        """),
    "workspace_source": _with(_WS, _SRC, select=(
        "SELECT * FROM src WHERE workspace_id IS NOT NULL AND " + _NOT_PERSONAL.format(c="workspace_type"))),
    "workspace_source_path": _with(_WS, _SRC, select=(
        "SELECT * FROM src WHERE workspace_id IS NOT NULL AND " + _NOT_PERSONAL.format(c="workspace_type"))),
    "workspace_source_quality": _with(_WS, _SRC, select=(
        "SELECT count(*) AS rows, count(*) FILTER (workspace_id IS NULL) AS null_ids, "
        "count(*) FILTER (workspace_id IS NOT NULL AND " + _NOT_PERSONAL.format(c="workspace_type")
        + ") AS not_personal FROM src")),
    "workspace_list_normalise": _with(_WS, select=(
        'SELECT id, name, type, cap_id AS "capacityId", cap_name AS "capacityName", '
        'dedicated AS "isOnDedicatedCapacity" FROM ws')),
    "modified_since": (
        "SELECT 'ws-' || o_custkey AS workspace_id, strftime(max(o_orderdate), '%Y-%m-%d') AS modified FROM orders "
        "WHERE o_orderdate >= TIMESTAMP '2001-06-01 00:00:00' GROUP BY o_custkey"),
    "lookback_window": _with(_WS, select="""
        SELECT count(*) FILTER (modified >= TIMESTAMP '2024-01-30 21:00:00') AS last_3_hours,
               count(*) FILTER (modified >= TIMESTAMP '2024-01-29 12:00:00') AS last_1_5_days,
               count(*) FILTER (modified >= TIMESTAMP '2024-01-30 00:00:00') AS by_default,
               count(*) FILTER (modified >= TIMESTAMP '2024-01-30 18:00:00') AS hours_win
        FROM ws"""),
    "scan_by_id": _conn(
        _best("both_sides", "age"), _EXISTING,
        f"""both_sides AS (
          SELECT {_COLUMNS}, 1 AS age FROM existing UNION ALL
          SELECT {_COLUMNS}, 0 FROM (SELECT {_bare_meta('conn')} FROM conn JOIN side USING (workspace_id) WHERE side.custkey // 100 = 1))"""),
    "scan_dir_two_scans": _conn(_best("kept"), f"kept AS (SELECT * FROM conn WHERE NOT ({_GONE}))"),
    "incremental_same_day": _conn(
        f"""SELECT id AS workspace_id, coalesce(connection_hash, sha256('')) AS connection_hash, coalesce(n, 0) AS connections
        FROM ws LEFT JOIN new_hash h ON h.workspace_id = id
        LEFT JOIN (SELECT workspace_id, count(*) AS n FROM ({_best("kept")}) GROUP BY workspace_id) c ON c.workspace_id = id""",
        f"kept AS (SELECT * FROM conn WHERE NOT ({_GONE}))", _hashes("new_hash", f"NOT ({_GONE})")),
    "stream_same_day_rescan": _conn(_prints("new_hash", "2024-01-31T00:00:00+00:00") + """
        UNION ALL SELECT id, name, coalesce(lower(type), ''), sha256(''), '2024-01-31T00:00:00+00:00' FROM ws
        WHERE id NOT IN (SELECT workspace_id FROM new_hash)""", _FULL_HASH),
    "stream_duplicate_landing": _conn(_prints("new_hash", "2024-01-31T00:00:00+00:00") + """
        UNION ALL SELECT id, name, coalesce(lower(type), ''), sha256(''), '2024-01-31T00:00:00+00:00' FROM ws
        WHERE id NOT IN (SELECT workspace_id FROM new_hash)""", _FULL_HASH),
    "stream_partitioned": _conn(_best("kept"), f"kept AS (SELECT * FROM conn WHERE NOT ({_GONE}))"),
    "payload_drift": _conn(
        "SELECT DISTINCT kind, path, found, CAST(NULL AS VARCHAR) AS expected FROM it, "
        "(VALUES ('newField.x', 'bigint'), ('newField.y[]', 'string')) v(path, found)"),
    "owner_search_indexed": _inv(
        "SELECT connector, target, workspace_name, item_name FROM inv WHERE workspace_users LIKE '%user1@example.org%'"),
    "workspace_lookup": _inv(f"SELECT {_KEY} FROM inv WHERE CAST(substr(workspace_id, 4) AS BIGINT) % 97 = 5"),
    "workspace_lookup_many": _inv(
        f"SELECT {_KEY} FROM inv WHERE workspace_id IN (SELECT workspace_id FROM cand) "
        "AND workspace_id NOT IN (SELECT workspace_id FROM recent)", _RECENT, _CAND),
    "connection_history": _conn(_HISTORY, _EXISTING, _INCOMING, _SCANS),
    "history_recorded": _conn(_HISTORY, _EXISTING, _INCOMING, _SCANS),
    "inventory_as_of": _conn(
        f"SELECT {_COLUMNS} FROM one JOIN (SELECT workspace_id, max(scan) AS scan FROM looked WHERE scan <= '2024-01-30' GROUP BY workspace_id) "
        "USING (workspace_id, scan)", _EXISTING, _INCOMING, _SCANS),
    "snapshot_between": _conn(
        f"""SELECT {_KEY}, CASE WHEN count(*) FILTER (side = 0) = 0 THEN 'added' ELSE 'changed' END AS change
        FROM both_sides GROUP BY {_KEY} HAVING count(*) FILTER (side = 1) > 0""", _EXISTING, _INCOMING, _BOTH),
    "version_merged": _conn(
        _best("both_sides"), _EXISTING, _INCOMING,
        f"""both_sides AS (
          SELECT {_COLUMNS} FROM existing WHERE {_NUMBER} % 2 <> 0 UNION ALL
          SELECT {_COLUMNS} FROM incoming WHERE {_NUMBER} % 2 = 0)"""),
    "fingerprint_drilldown": _conn("""
        SELECT workspace_id, item_id, CASE WHEN o.l IS NULL THEN 'added' WHEN n.l IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM old_items o FULL OUTER JOIN new_items n USING (workspace_id, item_id) WHERE o.l IS DISTINCT FROM n.l""",
        _item_docs("old_items", "dated < TIMESTAMP '2001-10-01'"), _item_docs("new_items", "dated >= TIMESTAMP '1995-02-01'")),
    "activity_summary_sketched": _with(_SHORT, select=(
        "SELECT count(*) AS calls, true AS users_within, true AS ips_within, true AS workspaces_within FROM inb")),
    "activity_top10_sketched": _with(_SHORT, select=(
        'SELECT activity, count("timestamp") AS events FROM inb GROUP BY activity ORDER BY events DESC, activity LIMIT 10')),
    "user_top10_sketched": _with(_SHORT, select=(
        'SELECT "user", count("timestamp") AS events FROM inb WHERE "user" IS NOT NULL GROUP BY "user" ORDER BY events DESC, "user" LIMIT 10')),
    "stream_day_tiles": """
        WITH d AS (SELECT CAST(range AS INTEGER) AS tile, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(range AS INTEGER)) AS dated
                   FROM range(30))
        SELECT tile, strftime(dated, '%Y-%m-%d %H:%M:%S') AS tile_start,
               strftime(dated + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS tile_end, count(ts) AS events, CAST(0 AS BIGINT) AS late
        FROM d LEFT JOIN events ON ts >= dated AND ts < dated + INTERVAL 1 DAY GROUP BY tile, dated""",
    "direction_sql": _conn(
        f"SELECT connector, server, endpoint, {_DIRECTION} AS direction, count(*) AS n FROM conn GROUP BY ALL"),
    "connector_counts_sql": _inv(
        "SELECT connector, count(*) AS connection_count FROM inv WHERE cloud GROUP BY connector"),
    "owner_connections_sql": _inv(
        "SELECT connector, target, workspace_name, item_name FROM inv WHERE workspace_users LIKE '%user1@example.org%'"),
    "outbound_sql": _inv(f"SELECT {_KEY} FROM inv WHERE {_DIRECTION} = 'outbound'"),
    "activity_events": _with(_EVENTS, select=(
        "SELECT * EXCLUDE (ts) FROM ev WHERE ts >= TIMESTAMP '2024-01-11 00:00:00' "
        "AND ts < TIMESTAMP '2024-01-31 00:00:00'")),
    "activity_filtered": _with(_EVENTS, select=(
        "SELECT * EXCLUDE (ts) FROM ev WHERE ts >= TIMESTAMP '2024-01-11 00:00:00' "
        "AND ts < TIMESTAMP '2024-01-31 00:00:00' AND \"Activity\" = 'ViewReport'")),
    "activity_by_day_tile": """
        WITH d AS (SELECT CAST(range AS INTEGER) AS tile, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(range AS INTEGER)) AS dated
                   FROM range(30))
        SELECT tile, strftime(dated, '%Y-%m-%d %H:%M:%S') AS tile_start,
               strftime(dated + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS tile_end, count(ts) AS events
        FROM d LEFT JOIN events ON ts >= dated AND ts < dated + INTERVAL 1 DAY GROUP BY tile, dated""",
    "flatten_all": _conn(f"SELECT {_COLUMNS} FROM conn"),
    "flatten_semantic_models": _conn(f"SELECT {_COLUMNS} FROM conn WHERE kind IN ('semanticmodel', 'dataset')"),
    "flatten_dataflows": _conn(f"SELECT {_COLUMNS} FROM conn WHERE kind = 'dataflow'"),
    "flatten_activities": _conn(f"SELECT {_COLUMNS} FROM conn WHERE kind = 'pipeline'"),
    "flatten_lakehouse_notebook": _conn(f"SELECT {_COLUMNS} FROM conn WHERE kind IN ('lakehouse', 'notebook')"),
    "flatten_other_items": _conn(f"SELECT {_COLUMNS} FROM conn WHERE kind IN ('report', 'unknown')"),
    "flatten_stats": _conn("""
        SELECT it.kind, count(DISTINCT it.custkey) AS workspaces, count(*) AS items,
               CAST(sum(coalesce(r.n, 0)) AS BIGINT) AS rows
        FROM it LEFT JOIN (SELECT k, count(*) AS n FROM conn GROUP BY k) r ON it.k = r.k GROUP BY it.kind"""),
    "legacy_dataset_count": _conn("SELECT count(*) AS datasources FROM it JOIN ref USING (k) WHERE p = '1' AND n % 5 <> 0"),
    "cloud_flag": _conn(
        "SELECT connection_scope, connector, count(*) FILTER (cloud) AS cloud_rows, "
        "count(*) FILTER (NOT cloud) AS other_rows FROM conn GROUP BY ALL"),
    "build_target": _conn("SELECT target, count(*) AS n FROM conn GROUP BY target"),
    "workspace_sidecar": _with(_WS, select=f"SELECT {_SIDE_COLUMNS} FROM side"),
    "sidecar_incremental": _with(_WS, select="""
        SELECT workspace_id, name, kind, users, CAST(NULL AS VARCHAR) AS capacity_id, 'Shared' AS capacity_name,
               false AS is_dedicated_capacity FROM side"""),
    "sidecar_listing": _with(_WS, select="""
        SELECT id AS workspace_id, name, 'workspace' AS kind, CAST(NULL AS VARCHAR) AS users, cap_id AS capacity_id,
               coalesce(cap_name, 'Shared') AS capacity_name, dedicated AS is_dedicated_capacity FROM ws"""),
    "workspace_owners_list": _with(_WS, select="SELECT id AS workspace_id, users AS workspace_users FROM ws"),
    "capacity_metadata": _with(_WS, select=(
        "SELECT workspace_id, capacity_id, capacity_name, is_dedicated_capacity FROM side")),
    "sidecar_lookup": _with(_WS, _RETURNED, select="""
        SELECT ws.id AS workspace_id, coalesce(r.name, ws.name) AS name, coalesce(r.kind, lower(ws.type), 'unknown') AS kind,
               r.users, r.capacity_id, coalesce(r.capacity_name, 'Shared') AS capacity_name,
               coalesce(r.is_dedicated_capacity, false) AS is_dedicated_capacity
        FROM ws LEFT JOIN returned r ON ws.id = r.workspace_id"""),
    "sidecar_backfill": _with(_WS, _RETURNED, select=f"""
        SELECT {_SIDE_COLUMNS} FROM returned UNION ALL
        SELECT id, name, lower(coalesce(type, 'unknown')), NULL, NULL, 'Shared', false FROM ws
        WHERE id NOT IN (SELECT workspace_id FROM returned)"""),
    "dedup_k6": _conn(_best("conn")),
    "merge_keep_existing": _conn(_best("both_sides", "side"), _EXISTING, _INCOMING, _BOTH),
    "merge_keep_incoming": _conn(_best("both_sides", "side DESC"), _EXISTING, _INCOMING, _BOTH),
    "merge_chunked": _conn(
        _best("chunks", "side DESC"),
        f"""chunks AS (
          SELECT {_COLUMNS}, 0 AS side FROM conn WHERE dated < TIMESTAMP '1998-01-01' UNION ALL
          SELECT {_COLUMNS}, 1 FROM (SELECT * REPLACE (item_name || ' c2' AS item_name) FROM conn
            WHERE dated >= TIMESTAMP '1997-01-01' AND dated < TIMESTAMP '2000-01-01') UNION ALL
          SELECT {_COLUMNS}, 2 FROM (SELECT * REPLACE (item_name || ' c3' AS item_name) FROM conn
            WHERE dated >= TIMESTAMP '1999-01-01'))"""),
    "snapshot_added": _conn(f"SELECT {_KEY} FROM incoming EXCEPT SELECT {_KEY} FROM existing", _EXISTING, _INCOMING),
    "snapshot_removed": _conn(f"SELECT {_KEY} FROM existing EXCEPT SELECT {_KEY} FROM incoming", _EXISTING, _INCOMING),
    "duplicate_check": _conn(f"SELECT {_KEY}, count(*) AS count FROM conn GROUP BY {_KEY} HAVING count(*) > 1"),
    "save_inventory": _conn(_best("both_sides", "side DESC"), _EXISTING, _INCOMING, _BOTH),
    "save_registered_table": _conn(_best("both_sides", "side DESC"), _EXISTING, _INCOMING, _BOTH),
    "save_partitioned": _conn(_best("both_sides", "side DESC"), _EXISTING, _INCOMING, _BOTH),
    "create_table_as": _inv("SELECT * FROM iw WHERE workspace_type <> 'personalgroup'", _INV_WS),
    "analysis_saved": _with(_EVENTS, select="SELECT * FROM inb"),
    "scan_dir_rejects": _with(_DOCS, select="""
        SELECT reason, position, CAST(sum(n) AS BIGINT) AS n FROM (
          SELECT 'invalid_json' AS reason, CAST(NULL AS INTEGER) AS position, 1 AS n FROM docs WHERE doc % 7 = 0
          UNION ALL SELECT 'element_not_object', 1, 1 FROM docs WHERE doc % 8 = 7) GROUP BY ALL"""),
    "scan_dir_partitioned": _conn(_best("conn")),
    "save_inventory_csv": _inv("""
        SELECT * REPLACE (CASE CAST(substr(item_id, 4) AS BIGINT) % 6 WHEN 0 THEN item_name || chr(10) || '"x", y'
          WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN ' ' || item_name || ',' WHEN 4 THEN chr(92) || item_name || '"'
          ELSE item_name END AS item_name) FROM inv"""),
    "payload_roundtrip": _conn(_best("conn")),
    "connections_with_direction": _inv(f"SELECT {_KEY}, {_DIRECTION} AS direction FROM inv"),
    "stream_ingest_merge": _conn(_best("conn")),
    "stream_two_runs": _conn(_best("kept"), f"kept AS (SELECT * FROM conn WHERE NOT ({_GONE}))"),
    "stream_fingerprints_rescan": _conn(_prints("new_hash", "2024-01-31T00:00:00+00:00") + """
        UNION ALL SELECT id, name, coalesce(lower(type), ''), sha256(''), '2024-01-31T00:00:00+00:00' FROM ws
        WHERE id NOT IN (SELECT workspace_id FROM new_hash)""", _FULL_HASH),
    "stream_fingerprints": _conn(_upserted(), _STORED_HASH, _FULL_HASH),
    "incremental_update": _conn(
        _best("both_sides"), _EXISTING, _RECENT, _TODO,
        f"""both_sides AS (
          SELECT {_COLUMNS} FROM existing WHERE workspace_id NOT IN (SELECT workspace_id FROM todo) UNION ALL
          SELECT {_COLUMNS} FROM conn WHERE workspace_id IN (SELECT workspace_id FROM todo))"""),
    "incremental_replace": _conn(
        _best("both_sides"), _RECENT, _TODO,
        f"""both_sides AS (
          SELECT {_COLUMNS} FROM (SELECT * REPLACE (item_name || ' v1' AS item_name) FROM conn)
          WHERE workspace_id NOT IN (SELECT workspace_id FROM todo) UNION ALL
          SELECT {_COLUMNS} FROM conn WHERE workspace_id IN (SELECT workspace_id FROM todo) AND NOT ({_GONE}))"""),
    "fingerprint_build": _conn(_prints("new_hash", "2024-01-31T00:00:00+00:00"), _FULL_HASH),
    "fingerprint_upsert": _conn(_upserted(), _STORED_HASH, _CURRENT_HASH),
    "fingerprint_diff": _conn("""
        SELECT workspace_id, o.connection_hash AS stored_hash, n.connection_hash AS current_hash,
               CASE WHEN o.connection_hash IS NULL THEN 'new' WHEN n.connection_hash IS NULL THEN 'absent'
                    WHEN o.connection_hash = n.connection_hash THEN 'unchanged' ELSE 'changed' END AS status
        FROM old_hash o FULL OUTER JOIN new_hash n USING (workspace_id)""", _STORED_HASH, _CURRENT_HASH),
    "recent_scan_skip": _with(_WS, _RECENT, _CAND, select=(
        "SELECT workspace_id FROM cand WHERE workspace_id NOT IN (SELECT workspace_id FROM recent)")),
    "recent_scan_reduction": _with(_WS, _RECENT, _CAND, select="""
        SELECT count(*) AS candidates, count(r.workspace_id) AS skipped, count(*) - count(r.workspace_id) AS to_scan,
               round(count(r.workspace_id) * 100.0::DOUBLE / count(*), 4) AS reduction_pct
        FROM cand LEFT JOIN recent r USING (workspace_id)"""),
    "classify_direction": _conn(
        f"SELECT connector, server, endpoint, {_DIRECTION} AS direction, count(*) AS n FROM conn GROUP BY ALL"),
    "direction_counts": _inv(f"SELECT {_DIRECTION} AS direction, count(*) AS connection_count FROM inv GROUP BY ALL"),
    "inbound_activity": _with(_EVENTS, select="SELECT * FROM inb"),
    "activity_summary": _with(_EVENTS, select=(
        'SELECT count(*) AS calls, count(DISTINCT "user") AS users, count(DISTINCT client_ip) AS ips, '
        "count(DISTINCT workspace_id) AS workspaces FROM inb")),
    "activity_top10": _with(_EVENTS, select=(
        'SELECT activity, count("timestamp") AS events FROM inb GROUP BY activity '
        "ORDER BY events DESC, activity LIMIT 10")),
    "capacity_distribution": _with(_WS, _KEYED, select="""
        SELECT capacity_key, CASE WHEN capacity_key = 'shared' THEN 'Shared Capacity'
               ELSE 'Capacity ' || substr(capacity_key, 1, 8) || '...' END AS display_name, count(*) AS workspaces
        FROM keyed GROUP BY capacity_key"""),
    "capacity_coverage": _with(_WS, select="""
        SELECT count(*) AS workspaces, count(*) FILTER (dedicated) AS dedicated, count(*) FILTER (NOT dedicated) AS shared,
               count(cap_id) AS with_capacity_id FROM ws"""),
    "capacity_filter": _with(_WS, _KEYED, select=(
        "SELECT id, capacity_key FROM keyed WHERE capacity_key IN ('cap-00000003', 'cap-00000006')")),
    "capacity_unknown": _with(_WS, _KEYED, select=(
        "SELECT c AS capacity_key FROM (VALUES ('cap-00000003'), ('cap-none'), ('shared')) v(c) "
        "WHERE c NOT IN (SELECT capacity_key FROM keyed)")),
    "capacity_order": _with(_WS, _KEYED, select="""
        SELECT capacity_key, workspaces, priority,
               CAST(row_number() OVER (ORDER BY priority NULLS LAST, workspaces DESC, capacity_key) AS INTEGER) AS position
        FROM (SELECT capacity_key, count(*) AS workspaces,
                     CASE capacity_key WHEN 'cap-00000012' THEN 1 WHEN 'shared' THEN 2 WHEN 'cap-none' THEN 3 END AS priority
              FROM keyed GROUP BY capacity_key)"""),
    "scan_plan": _plan("SELECT * FROM plan"),
    "scan_plan_full": _with(_WS, _KEYED, f"""
        kept AS (SELECT * FROM keyed WHERE {_NOT_PERSONAL.format(c="type")} AND capacity_key <> 'cap-00000003'),
        caps AS (
          SELECT capacity_key, row_number() OVER (ORDER BY CASE capacity_key WHEN 'cap-00000012' THEN 1 WHEN 'shared' THEN 2 END
            NULLS LAST, count(*) DESC, capacity_key) AS position FROM kept GROUP BY capacity_key),
        numbered AS (
          SELECT id, capacity_key, position, row_number() OVER (ORDER BY position, substr(md5(id), 1, 3), id) - 1 AS seq
          FROM kept JOIN caps USING (capacity_key))""", select="""
        SELECT id, capacity_key, CAST(position AS INTEGER) AS position, seq, CAST(seq // 10 AS INTEGER) AS batch_no,
               CAST(seq // 40 AS INTEGER) AS chunk_no FROM numbered"""),
    "scan_plan_by_capacity": _with(_WS, _KEYED, _CAP_PLAN, select="SELECT * FROM plan"),
    "remaining_batches": _plan("SELECT id, batch_no FROM plan WHERE batch_no NOT IN (SELECT batch_no FROM completed)"),
    "scan_progress": _plan("""
        SELECT count(*) AS total_batches, count(c.batch_no) AS completed, count(*) - count(c.batch_no) AS remaining,
               round(count(c.batch_no) * 100.0::DOUBLE / count(*), 4) AS completed_pct,
               round((count(*) - count(c.batch_no)) / 4.0::DOUBLE, 4) AS hours_left
        FROM (SELECT DISTINCT batch_no FROM plan) b LEFT JOIN completed c USING (batch_no)"""),
    "scan_estimate": _with(_WS, select="""
        SELECT count(*) AS workspaces, CAST(ceil(count(*) / 100.0) AS BIGINT) AS batches,
               round(count(*) * 8.0::DOUBLE / 100, 4) AS calls,
               round(ceil(count(*) / 100.0) / 4.0::DOUBLE, 4) AS hours,
               CAST(ceil(ceil(count(*) / 100.0) / 4.0) AS BIGINT) AS whole_hours FROM ws"""),
    "exclude_personal": _with(_WS, select="SELECT id, type FROM ws WHERE " + _NOT_PERSONAL.format(c="type")),
    "workspace_subset": _inv(
        f"SELECT {_KEY} FROM inv WHERE workspace_id IN (SELECT workspace_id FROM cand) "
        "AND workspace_id NOT IN (SELECT workspace_id FROM recent)", _RECENT, _CAND),
    "workspace_rename": _with(_WS, select=(
        "SELECT id AS workspace_id, name AS workspace_name, type AS workspace_type, cap_id AS capacity_id FROM ws")),
    "workspace_inventory": _inv("SELECT * FROM iw WHERE workspace_type <> 'personalgroup'", _INV_WS),
    "inventory_distinct": _inv(
        f"SELECT DISTINCT {_KEY}, workspace_name, workspace_kind, workspace_users, item_name, item_type, item_creator, "
        "item_modified_by, item_modified_date, target, connection_scope, cloud, generation FROM inv"),
    "inventory_prod_only": _inv(
        "SELECT * FROM iw WHERE workspace_name NOT LIKE '%Test%' AND workspace_name NOT LIKE '%Dev%' "
        "AND workspace_type <> 'personalgroup'", _INV_WS),
    "inventory_by_capacity": _inv(
        "SELECT * FROM iw WHERE workspace_type NOT IN ('personalgroup', 'test', 'development') "
        "AND capacity_id IN ('cap-00000003', 'cap-00000007')", _INV_WS),
    "inventory_totals": _inv(
        "SELECT count(*) AS row_count, count(DISTINCT workspace_id) AS workspaces_scanned, "
        "max(item_modified_date) AS latest_modified FROM inv"),
    "connector_counts": _inv("SELECT connector, count(*) AS connection_count FROM inv GROUP BY connector"),
    "cloud_connector_counts": _inv(
        "SELECT connector, count(*) AS connection_count FROM inv WHERE cloud GROUP BY connector"),
    "connector_summary": _inv(
        "SELECT connector, count(DISTINCT workspace_id) AS workspace_count, count(*) AS connection_count "
        "FROM inv GROUP BY connector"),
    "owner_summary": _inv(
        "SELECT workspace_users, count(*) AS connection_count, count(DISTINCT connector) AS unique_connectors "
        "FROM inv WHERE workspace_users IS NOT NULL GROUP BY workspace_users"),
    "workspace_connection_top20": _inv(
        "SELECT workspace_name, connector, server, database, count(*) AS connection_count FROM inv GROUP BY ALL "
        "ORDER BY connection_count DESC, workspace_name NULLS FIRST, connector NULLS FIRST, server NULLS FIRST, "
        "database NULLS FIRST LIMIT 20"),
    "report_cloud_with_owners": _inv(
        "SELECT connector, target, workspace_name, workspace_users, item_name FROM inv WHERE cloud"),
    "report_cloud_by_connector": _inv(
        "SELECT connector, target, workspace_name, item_name, item_type FROM inv WHERE cloud"),
    "report_connector_in": _inv(
        f"SELECT {_COLUMNS} FROM inv WHERE connector IN ('azuresqldatabase', 'synapse', 'snowflake')"),
    "report_by_owner_like": _inv(
        "SELECT connector, target, workspace_name, item_name FROM inv WHERE workspace_users LIKE '%user1@example.org%'"),
    "report_recently_modified": _inv(
        "SELECT item_name, item_modified_by, item_modified_date, connector, target FROM inv "
        "WHERE item_modified_date IS NOT NULL ORDER BY item_modified_date DESC, workspace_id, item_id, connector, "
        "server NULLS FIRST, database NULLS FIRST, endpoint NULLS FIRST LIMIT 20"),
    "redacted_summary": _inv(
        "SELECT connector, 'REDACTED' AS server, 'REDACTED' AS workspace_users, count(*) AS connection_count "
        "FROM inv GROUP BY connector"),
    "request_rate": _with(_LOG, """
        s AS (SELECT day, count(*) AS calls, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM log GROUP BY day),
        r AS (SELECT *, CASE WHEN seconds > 0 THEN calls / seconds * 3600 ELSE 0 END AS rate FROM s)""", select="""
        SELECT day, calls, round(seconds / 60, 4) AS elapsed_minutes, round(rate, 4) AS rate_per_hour,
               round(rate / 500 * 100, 4) AS percentage_used,
               CASE WHEN rate > 450 THEN 'warning' WHEN rate > 350 THEN 'moderate' ELSE 'healthy' END AS band FROM r"""),
    "contention_status": _with(_LOG, """
        s AS (SELECT hour, count(*) AS requests, count(*) FILTER (status = 200) AS successful,
                     count(*) FILTER (status = 429) AS throttled FROM log GROUP BY hour),
        r AS (SELECT *, throttled * 100.0::DOUBLE / requests AS pct FROM s),
        t AS (SELECT *, CASE WHEN throttled = 0 THEN 'clear' WHEN throttled = 1 AND requests >= 4 THEN 'light'
                             WHEN pct >= 50 THEN 'heavy' ELSE 'moderate' END AS status FROM r)""", select="""
        SELECT hour, requests, successful, throttled, round(pct, 4) AS throttled_pct, status,
               CASE status WHEN 'clear' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END AS recommended_parallel,
               CASE status WHEN 'clear' THEN 0 WHEN 'light' THEN 100 WHEN 'heavy' THEN 400 ELSE 250 END
                 AS estimated_other_usage,
               status <> 'heavy' AS safe_to_proceed FROM t"""),
}
