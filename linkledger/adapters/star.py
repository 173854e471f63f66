"""Inventory inputs derived from the star-schema test tables.

Customers stand for workspaces, orders for items, line items for references and events
for the activity and request logs. Everything is plain expressions over whole tables, so
that the same data can be written as SQL.

Payload documents hold about a hundred workspaces. Every document comes in ``FRAGMENTS``
fragments, to which its references are dealt by row, so that neither a workspace nor an
item is in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X
from linkledger.operators import flatten as FL
from linkledger.operators import sidecar as SC
from linkledger.schemas import REFERENCE_DDL

AS_OF = "2024-01-31 00:00:00"
CUTOFF = "1999-01-01"
OVERLAP = "1998-01-01"
FRAGMENTS = 4

# Raw connector names by brand number, chosen to reach every rule.
CONNECTORS = [
    "AzureSqlDatabase", "Snowflake", "Salesforce", "SharePointOnline", "Dynamics365",
    "REST", "Web", "S3", "Oracle", "MySQL", "PostgreSQL", "Kusto", "Synapse",
    "OneLake", "FabricLakehouse", "Lakehouse", "ADLS", "ABFSS", "SqlServerless",
    "Sql", "File", "Folder", "Odbc", None, "",
]


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; its schema is read from the file once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def stamp(text: str) -> Column:
    """A time of the tables' own type, which has no zone; comparing it needs no cast of the
    column, so it reaches the scan."""
    return F.lit(text).cast("timestamp_ntz")


# --- workspaces -------------------------------------------------------------------------

def workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workspace list: ``id, name, type, capacityId, capacityName, isOnDedicatedCapacity``
    and ``modified``, with the customer key kept for joins."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return c.join(n, "c_nationkey", "left").selectExpr(
        "c_custkey AS custkey",
        "concat('ws-', c_custkey) AS id",
        "concat(c_name, CASE c_custkey % 10 WHEN 3 THEN ' Test' WHEN 7 THEN ' Dev' ELSE '' END) AS name",
        "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN 'PersonalGroup' "
        "ELSE 'Workspace' END AS type",
        "CASE WHEN c_nationkey % 5 <> 0 THEN concat('cap-', lpad(c_nationkey, 8, '0')) END AS capacityId",
        "CASE WHEN c_custkey % 2 = 0 THEN n_name END AS capacityName",
        "(c_nationkey % 5 <> 0 AND c_nationkey % 7 <> 1) AS isOnDedicatedCapacity",
        f"TIMESTAMP '{AS_OF}' - make_dt_interval(0, CAST(c_custkey % 97 AS int)) AS modified",
    )


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve users per group of 180 workspaces, in key order."""
    right = "CASE s_suppkey % 3 WHEN 0 THEN 'Admin' WHEN 1 THEN 'Member' ELSE 'Viewer' END"
    user = (
        "named_struct('emailAddress', CASE WHEN s_suppkey % 7 <> 0 THEN concat('user', s_suppkey, '@example.org') END, "
        "'identifier', concat('id-', s_suppkey), "
        f"'workspaceUserAccessRight', CASE WHEN s_suppkey % 11 <> 0 THEN {right} END, "
        f"'groupUserAccessRight', CASE WHEN s_suppkey % 11 = 0 THEN {right} END)"
    )
    return (
        table(spark, sf_dir, "supplier")
        .selectExpr("s_suppkey div 12 AS g", f"struct(s_suppkey AS s, {user} AS u) AS e")
        .groupBy("g").agg(F.expr("array_sort(collect_list(e)) AS l"))
        .selectExpr("g", "transform(l, e -> e.u) AS users")
    )


def workspaces_with_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = workspaces(spark, sf_dir).withColumn("g", F.expr("custkey div 180"))
    return ws.join(_users(spark, sf_dir), "g", "left").drop("g")


_LABEL = SC.capacity_label("capacityId", "capacityName", "isOnDedicatedCapacity")


def workspace_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workspace columns of the connection row, as a scan's sidecar would give them.

    Some workspaces are left out of the sidecar, so their defaults show.
    """
    present = "custkey % 13 <> 5"
    return workspaces_with_users(spark, sf_dir).selectExpr(
        "custkey", "id AS workspace_id", "name AS workspace_name", f"{X.kind_of('type')} AS workspace_kind",
        f"CASE WHEN {present} THEN {SC.owners('users')} END AS workspace_users",
        f"CASE WHEN {present} THEN capacityId END AS capacity_id",
        f"CASE WHEN {present} THEN {_LABEL} ELSE '{V.SHARED_CAPACITY}' END AS capacity_name",
        f"({present} AND isOnDedicatedCapacity) AS is_dedicated_capacity",
    )


def workspace_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user-kept workspace table with some ids missing."""
    return workspaces(spark, sf_dir).selectExpr(
        "CASE WHEN custkey % 23 <> 0 THEN id END AS workspace_id", "name AS workspace_name",
        "type AS workspace_type", "capacityId AS capacity_id",
    )


# --- items and references ----------------------------------------------------------------

_RAW_TYPE = (
    "CASE left(o_orderpriority, 1) "
    "WHEN '1' THEN CASE WHEN o_orderkey % 4 = 1 THEN 'Dataset' ELSE 'SemanticModel' END "
    "WHEN '2' THEN 'Dataflow' WHEN '3' THEN 'Pipeline' "
    "WHEN '4' THEN CASE WHEN o_orderstatus = 'F' THEN 'Lakehouse' ELSE 'Notebook' END "
    "ELSE CASE WHEN o_orderkey % 6 <> 5 THEN 'Report' END END"
)
_KIND = f"{X.lower_or_unknown(_RAW_TYPE)} AS kind"
_READS = "left(o_orderpriority, 1) <> '5'"
#: What an item is told from: short columns, which joins move instead of the texts made of them.
_ITEM_SOURCE = ["o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]
_ITEM_RAW = [
    "concat('it-', o_orderkey) AS id", "concat('item ', o_orderkey) AS name",
    f"{_RAW_TYPE} AS type",
    "CASE o_orderkey % 3 WHEN 2 THEN concat('u', o_orderkey % 50) WHEN 1 THEN '' END AS createdBy",
    "concat('cfg', o_orderkey % 20) AS configuredBy", "concat('m', o_orderkey % 30) AS modifiedBy",
    "CASE WHEN o_orderstatus <> 'P' THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END "
    "AS modifiedDateTime",
    "CASE WHEN o_orderkey % 2 = 0 THEN '2' END AS generation",
    "named_struct('generation', CASE WHEN o_orderkey % 4 = 1 THEN '1' END) AS properties",
]


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with raw payload fields; ``kind`` is the lower-case type, ``reads`` tells
    whether the kind has references at all."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS custkey", "o_orderkey AS orderkey", "o_orderdate AS item_date", _KIND, f"{_READS} AS reads", *_ITEM_RAW
    )


_NAMES = ", ".join("NULL" if c is None else f"'{c}'" for c in CONNECTORS)
#: The fields of a reference, told from a line item and its part.
_REF_FIELDS = [
    f"element_at(array({_NAMES}), brand) AS con", "concat('Provider', brand % 3) AS provider",
    "CASE l_suppkey % 4 WHEN 0 THEN concat('srv', l_suppkey % 10, '.database.windows.net') "
    "WHEN 1 THEN concat('onelake', l_suppkey % 10, '.windows.net') "
    "WHEN 2 THEN concat('host', l_suppkey % 10, '.corp.local') ELSE '' END AS server",
    "CASE WHEN l_suppkey % 4 <> 3 THEN 'ignored' "
    "WHEN l_suppkey % 8 = 3 THEN concat('gw', l_suppkey % 10, '.snowflakecomputing.com') END AS host",
    "CASE WHEN p_size % 5 <> 0 THEN concat('db', p_size % 5) END AS db1",
    "CASE WHEN p_size % 10 = 0 THEN 'legacy' END AS db2",
    "CASE WHEN l_linenumber % 4 <> 0 THEN concat('https://h', l_suppkey % 10, "
    "CASE WHEN l_suppkey % 6 = 5 THEN '.azure.com/' ELSE '.example/' END, l_partkey % 5) END AS url",
    "concat('/p/', l_partkey % 5) AS other",
    "CASE returned WHEN 0 THEN parse_json('\"gw-1\"') WHEN 1 THEN parse_json('\"\"') END AS gateway",
    "CASE WHEN l_linenumber % 3 = 1 THEN "
    "CASE WHEN closed = 0 THEN parse_json('true') ELSE parse_json('false') END WHEN l_linenumber % 3 = 2 THEN "
    "CASE WHEN returned = 1 THEN parse_json('null') ELSE parse_json('true') END END AS isCloud",
]
_REF = (
    "named_struct('gatewayId', gateway, 'connectionDetails', named_struct('datasourceType', con, 'server', server, "
    "'host', host, 'database', db1, 'db', db2), 'type', con, 'provider', provider, 'url', url, 'path', other, "
    "'endpoint', other, 'isCloud', isCloud, 'linkedService', CASE WHEN line % 5 <> 0 THEN named_struct('type', con, "
    "'url', url, 'endpoint', other, 'gatewayId', gateway) END) AS ref"
)


#: What a reference needs of a line item and of its part, as the 32 bits of one number: in shuffles, it costs less than half of the columns.
#: Every term is (column, the part of it that is used, its least value, its bits, whether all bits set are null). Keys and numbers are cut to the
#: remainders that are used (120: of 4, 6, 8 and 10; 60: of 2, 3, 4 and 5); brands past the list of names stay past it and keep theirs of 3.
_LINE_TERMS = [
    ("l_partkey", "l_partkey % 5", -4, 4, False), ("l_suppkey", "l_suppkey % 120", -119, 8, True), ("l_linenumber", "l_linenumber % 60", -59, 7, True),
    ("returned", "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END", 0, 2, False), ("closed", "CASE l_linestatus WHEN 'O' THEN 0 END", 0, 1, False),
]
_PART_TERMS = [("p_size", "p_size % 10", -9, 5, True), ("brand", "CASE WHEN brand > 26 THEN 27 + brand % 3 ELSE brand END", 0, 5, True)]
#: The number of a row, and the bits of a part in it.
_REF_CODE, _PART_BITS = "ref_code", sum(term[3] for term in _PART_TERMS)


def _packed(terms: list[tuple[str, str, int, int, bool]]) -> str:
    code = "0"
    for _, value, least, bits, _ in terms:
        code = f"(shiftleft({code}, {bits}) | CAST(coalesce({value} - ({least}), {(1 << bits) - 1}) AS int))"
    return code


def _unpacked(code: str, terms: list[tuple[str, str, int, int, bool]]) -> list[str]:
    """The columns back from :func:`_packed`; ``returned`` and ``closed`` are numbers."""
    found, below = [], 0
    for name, _, least, bits, nullable in reversed(terms):
        digit = f"(shiftrightunsigned({code}, {below}) & {(1 << bits) - 1})"
        found.append(f"{f'nullif({digit}, {(1 << bits) - 1})' if nullable else digit} + ({least}) AS {name}")
        below += bits
    return found


def _reference_source(spark: SparkSession, sf_dir: str, keep: list[str]) -> DataFrame:
    """``orderkey``, ``keep`` and what the references are told from, by line item."""
    # The position in the scan tells copies of a row apart when a document is split.
    line = table(spark, sf_dir, "lineitem").selectExpr("*", "monotonically_increasing_id() AS _at")
    line = line.selectExpr("l_orderkey AS orderkey", "l_partkey", *keep, f"{_packed(_LINE_TERMS)} AS _line")
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS l_partkey", "p_size", "CAST(regexp_extract(p_brand, r'([0-9]+)$', 1) AS int) AS brand",
    ).selectExpr("l_partkey", f"{_packed(_PART_TERMS)} AS _part")
    return line.join(part, "l_partkey").drop("l_partkey").withColumn(_REF_CODE, F.expr(f"shiftleft(_line, {_PART_BITS}) | _part")).drop("_line", "_part")


def _with_reference(rows: DataFrame) -> DataFrame:
    """The ``line`` and ``ref`` struct in place of what they are told from."""
    rest = [c for c in rows.columns if c != _REF_CODE]
    told = rows.selectExpr(*rest, *_unpacked(_REF_CODE, [*_LINE_TERMS, *_PART_TERMS]))
    return told.selectExpr(*rest, "l_linenumber AS line", *_REF_FIELDS).selectExpr(*rest, "line", _REF)


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reference struct per line item, keyed by order."""
    return _with_reference(_reference_source(spark, sf_dir, ["l_shipdate AS ship_date", "_at"]))


# Item columns of the connection row, from raw item fields.
_ITEM = [
    "id AS item_id", "name AS item_name", "kind", f"{X.first_filled('createdBy', 'configuredBy')} AS item_creator",
    "modifiedBy AS item_modified_by", "modifiedDateTime AS item_modified_date",
    f"CASE WHEN {FL.DATAFLOW} THEN {X.first_filled('generation', 'properties.generation')} END AS generation",
]


def connections(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None, name_suffix: str = ""
) -> DataFrame:
    """Connection rows without the detour over JSON, duplicates included.

    ``since`` and ``until`` bound the ship date of references and the date of
    placeholder rows, which makes snapshots that overlap.
    """
    def bounded(df: DataFrame, column: str) -> DataFrame:
        if since:
            df = df.filter(F.col(column) >= stamp(since))
        return df.filter(F.col(column) < stamp(until)) if until else df

    # Joins move keys and the short columns that texts are told from; the texts are made behind the last join. That one is
    # by the workspace's id, which the connection key begins with: rows are dealt as merging needs them and are not dealt again.
    # The number of tasks is given because rows grow behind the join, which packing small partitions together ignores.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS orderkey", *_ITEM_SOURCE)
    refs = bounded(_reference_source(spark, sf_dir, ["l_shipdate"]), "l_shipdate").drop("l_shipdate")
    with_refs = orders.filter(_READS).join(refs, "orderkey").withColumn("_read", F.lit(True))
    placeholders = bounded(orders.filter(f"NOT {_READS}"), "o_orderdate").withColumn("_read", F.lit(False))
    source = with_refs.unionByName(placeholders, allowMissingColumns=True).drop("orderkey")
    keyed = source.withColumn("workspace_id", F.expr("concat('ws-', o_custkey)")).repartition(tasks, "workspace_id")
    rows = keyed.join(workspace_meta(spark, sf_dir).drop("custkey"), "workspace_id")
    suffix = f"concat(name, {X.quoted(name_suffix)})" if name_suffix else "name"
    meta = [c for c in rows.columns if c in FL.META]
    shaped = _with_reference(rows.selectExpr(*meta, "_read", _KIND, *_ITEM_RAW, _REF_CODE)).selectExpr(
        *meta, *[c.replace("name AS", f"{suffix} AS") if c == "name AS item_name" else c for c in _ITEM],
        f"CASE WHEN _read THEN ref ELSE {FL.EMPTY_REFERENCE} END AS ref",
    )
    return FL.connection_rows(shaped)


# --- payload documents ---------------------------------------------------------------------

_OTHER = f"NOT ({FL.SEMANTIC} OR {FL.DATAFLOW} OR {FL.ACTIVITY} OR {FL.REFERENCE})"

# Only the reference fields a kind spells out, so the text stays small.
_SLIM = "named_struct(" + ", ".join(
    f"'{name}', CASE WHEN {rule} THEN ref.{name} END" for name, rule in {
        "gatewayId": f"({FL.SEMANTIC} OR {_OTHER})", "connectionDetails": f"({FL.SEMANTIC} OR {_OTHER})",
        "type": f"({FL.DATAFLOW} OR {FL.ACTIVITY} OR {FL.REFERENCE})", "provider": FL.DATAFLOW,
        "url": f"({FL.DATAFLOW} OR {FL.REFERENCE})", "path": FL.DATAFLOW, "endpoint": FL.REFERENCE,
        "isCloud": FL.REFERENCE, "linkedService": FL.ACTIVITY,
    }.items()
) + ")"

# The item's reference arrays as the payload spells them, from the sorted-out ``refs``.
_PLAIN = "transform(refs, r -> r.ref)"
_ARRAYS = [
    # Items of other kinds carry references too, which flattening has to leave alone.
    f"CASE WHEN {FL.SEMANTIC} OR {_OTHER} THEN {_PLAIN} END AS datasources",
    f"CASE WHEN {FL.DATAFLOW} THEN CASE WHEN orderkey % 3 <> 0 THEN {_PLAIN} "
    f"ELSE CAST(array() AS array<{REFERENCE_DDL}>) END END AS sources",
    f"CASE WHEN {FL.DATAFLOW} AND orderkey % 3 = 0 THEN {_PLAIN} END AS entities",
    f"CASE WHEN {FL.ACTIVITY} THEN {_PLAIN} END AS activities",
    f"CASE WHEN {FL.REFERENCE} THEN transform(filter(refs, r -> r.line % 2 = 1), r -> r.ref) END AS connections",
    f"CASE WHEN {FL.REFERENCE} THEN transform(filter(refs, r -> r.line % 2 = 0), r -> r.ref) END AS lineage",
]
_ITEM_FIELDS = [
    "id", "name", "type", "createdBy", "configuredBy", "modifiedBy", "modifiedDateTime", "generation", "properties",
]
_SIDE = (
    "named_struct('key', head.id, 'value', named_struct('name', head.name, "
    f"'kind', {X.kind_of('head.type')}, 'users', {SC.owners('head.users')}, 'capacity_id', head.capacityId, "
    f"'capacity_name', {SC.capacity_label('head.capacityId', 'head.capacityName', 'head.isOnDedicatedCapacity')}, "
    "'is_dedicated_capacity', head.isOnDedicatedCapacity))"
)


def payload_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc, part, payload)``: about a hundred workspaces each, with their sidecar."""
    # As in connections, joins and the shuffle move keys and short columns; items and references are made behind them.
    part = f"CAST(pmod({{}}, {FRAGMENTS}) AS int) AS part"
    whole = "xxhash64(o_orderkey)"
    source = [c for c in _ITEM_SOURCE if c != "o_custkey"]
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS orderkey", "o_custkey AS custkey", "o_custkey div 100 AS doc", *source)
    refs = _reference_source(spark, sf_dir, [f"CAST(pmod(xxhash64(_at), {FRAGMENTS}) AS tinyint) AS _dealt"])
    lines = orders.join(refs, "orderkey").selectExpr("*", _KIND).selectExpr(
        "doc", part.format(f"CASE WHEN {_OTHER} THEN {whole} ELSE _dealt END"), "custkey", *source, _REF_CODE, "'line' AS _row"
    )
    # Every item once without a reference, so that items lacking any still appear. Items of other
    # kinds give one row each, so theirs stay together.
    bare = orders.selectExpr("doc", part.format(whole), "custkey", *source, "'item' AS _row")
    heads = (
        workspaces_with_users(spark, sf_dir).selectExpr(
            "custkey div 100 AS doc", f"explode(sequence(0, {FRAGMENTS - 1})) AS part", "custkey", "'workspace' AS _row",
            "struct(id, name, type, capacityId, capacityName, isOnDedicatedCapacity, users) AS head",
        )
    )
    rows = lines.unionByName(bare, allowMissingColumns=True).unionByName(heads, allowMissingColumns=True)
    # One shuffle serves all three levels of nesting, by document alone: an item's lines travel side by side, where its
    # columns compress, and its fragments come apart behind it. The number is given because small
    # documents would otherwise be packed into few tasks, although writing JSON is the cost.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "doc").selectExpr(
        "doc", "part", "custkey", "_row", "head", "o_orderkey AS orderkey", _KIND, *_ITEM_RAW, _REF_CODE
    )
    made = _with_reference(dealt).selectExpr(
        "doc", "part", "custkey", "head",
        f"CASE WHEN _row <> 'workspace' THEN struct(orderkey, kind, {', '.join(_ITEM_FIELDS)}) END AS item",
        f"CASE WHEN _row = 'line' THEN named_struct('line', line, 'ref', {_SLIM}) END AS r",
    )
    per_item = made.groupBy("doc", "part", "custkey", "item").agg(
        F.expr("collect_list(r) AS refs"), F.expr("first(head, true) AS head")
    )
    built = per_item.selectExpr("doc", "part", "custkey", "head", "item", "refs", "item.kind", "item.orderkey").selectExpr(
        "doc", "part", "custkey", "head",
        f"CASE WHEN item IS NOT NULL THEN struct({', '.join(f'item.{c}' for c in _ITEM_FIELDS)}, "
        f"{', '.join(_ARRAYS)}) END AS item",
    )
    per_ws = built.groupBy("doc", "part", "custkey").agg(
        F.expr("collect_list(item) AS items"), F.expr("first(head, true) AS head")
    )
    nested = per_ws.selectExpr(
        "doc", "part",
        "struct(head.id, head.name, head.type, head.capacityId, head.capacityName, head.isOnDedicatedCapacity, "
        "head.users, items) AS w",
        f"CASE WHEN custkey % 13 <> 5 THEN {_SIDE} END AS side",
    )
    return nested.groupBy("doc", "part").agg(F.expr(
        "struct(collect_list(w) AS workspaces, map_from_entries(collect_list(side)) AS workspace_sidecar) AS payload"
    ))


# What a second scan returns: every other workspace, without some of its items, of some without any.
_RESCANNED = (
    "named_struct('workspaces', transform(filter(payload.workspaces, w -> CAST(substr(w.id, 4) AS bigint) % 2 = 0), "
    "w -> struct(w.id, w.name, w.type, w.capacityId, w.capacityName, w.isOnDedicatedCapacity, w.users, filter(w.items, "
    "i -> CAST(substr(w.id, 4) AS bigint) % 10 <> 0 AND CAST(substr(i.id, 4) AS bigint) % 3 <> 0) AS items)), "
    "'workspace_sidecar', payload.workspace_sidecar)"
)


def documents(spark: SparkSession, sf_dir: str, broken: bool = False, rescan: bool = False) -> DataFrame:
    """Payload documents as ``(path, text)``: object roots, list roots, some with junk in the list.

    ``rescan`` gives a second scan, in which half of the workspaces have lost connections.

    ``broken`` adds a cut-off copy of some documents, which must be rejected. Fragments of
    a split document carry its file name under a folder of their own.
    """
    docs = payload_structs(spark, sf_dir).selectExpr(
        "doc", "part", "concat(CASE WHEN part > 0 THEN concat('part-', part, '/') ELSE '' END, 'scan-', doc, '.json') "
        "AS path", f"to_json({_RESCANNED if rescan else 'payload'}) AS text",
    ).selectExpr(
        "doc", "part", "path",
        "CASE WHEN doc % 8 = 7 AND part = 0 THEN concat('[', text, ', 7]') WHEN doc % 2 = 1 THEN concat('[', text, ']') "
        "ELSE text END AS text",
    )
    if broken:
        docs = docs.selectExpr(
            "inline(filter(array(struct(path, text), CASE WHEN doc % 7 = 0 AND part = 0 THEN "
            "struct(concat('cut-', path) AS path, left(text, length(text) - 3) AS text) END), d -> d IS NOT NULL))"
        )
    return docs.select("path", "text")


# --- activity and request logs ---------------------------------------------------------------

def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity events in the shape of the landed log."""
    e = table(spark, sf_dir, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS int) AS k")
    return e.selectExpr(
        "CASE event_type WHEN 'view' THEN 'ViewReport' WHEN 'click' THEN 'GetDataset' WHEN 'purchase' THEN "
        "'ExecuteQueries' WHEN 'error' THEN 'ExportReport' ELSE 'CreateDataset' END AS Activity",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS CreationTime",
        "CASE WHEN user_id % 19 <> 0 THEN concat('user', user_id) END AS UserId",
        "concat('10.0.', user_id % 7, '.', k % 16) AS ClientIP",
        "CASE k % 4 WHEN 0 THEN 'Mozilla/5.0' WHEN 1 THEN '' WHEN 3 THEN 'python-requests/2.31' END AS UserAgent",
        "CASE WHEN user_id % 5 <> 0 THEN concat('ws-', user_id % 40) END AS WorkspaceId",
        "concat('Workspace ', user_id % 40) AS WorkspaceName",
        "CASE WHEN event_type IN ('click', 'purchase') THEN concat('ds-', k) END AS DatasetId",
        "CASE WHEN event_type IN ('click', 'purchase') THEN concat('Dataset ', k) END AS DatasetName",
        "CASE WHEN event_type IN ('view', 'error') THEN concat('rp-', k) END AS ReportId",
        "CASE WHEN event_type IN ('view', 'error') THEN concat('Report ', k) END AS ReportName",
        "CASE event_type WHEN 'error' THEN false WHEN 'view' THEN true END AS IsSuccess",
    )


def activity_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as landed pages of up to 500, JSON text per page."""
    return pages_of(activity_events(spark, sf_dir))


def pages_of(e: DataFrame) -> DataFrame:
    page = e.selectExpr("monotonically_increasing_id() div 500 AS page", f"struct({', '.join(e.columns)}) AS e")
    return page.groupBy("page").agg(F.expr("collect_list(e) AS activityEventEntities")).selectExpr(
        "to_json(struct(activityEventEntities, CASE WHEN page % 2 = 0 THEN concat('t', page) END AS continuationToken)) "
        "AS text"
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log ``(ts, endpoint, status, day)``: errors stand for throttled calls."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(ts AS timestamp) AS ts", "event_type AS endpoint",
        "CASE WHEN event_type = 'error' THEN 429 ELSE 200 END AS status", "date_format(ts, 'yyyy-MM-dd') AS day",
    )


# --- stored state -----------------------------------------------------------------------------

def stored_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan times stored for the workspaces seen before: spread over two days, some
    unreadable or missing."""
    at = f"(TIMESTAMP '{AS_OF}' - make_dt_interval(0, CAST(c_custkey % 48 AS int)))"
    return table(spark, sf_dir, "customer").filter("c_acctbal >= 2500").selectExpr(
        "concat('ws-', c_custkey) AS workspace_id",
        "CASE WHEN c_custkey % 29 = 0 THEN 'not-a-time' WHEN c_custkey % 31 = 0 THEN NULL "
        f"WHEN c_custkey % 2 = 0 THEN date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss.0000000'Z'\") "
        f"ELSE date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\") END AS last_scan_time",
    )
