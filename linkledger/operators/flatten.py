"""Flattening: nested payloads to connection rows.

One narrow pass: workspaces, items and references are exploded in turn, and every item
kind shares the same reference type, so there is a single explode per level, no shuffle
and no second look at the payload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X
from linkledger.schemas import CONNECTION_COLUMNS, REFERENCE_DDL

META = [
    "workspace_id", "workspace_name", "workspace_kind", "workspace_users",
    "capacity_id", "capacity_name", "is_dedicated_capacity",
]

# Which reading rule an item kind follows.
SEMANTIC = f"kind IN ({X.quoted(*V.SEMANTIC_TYPES)})"
DATAFLOW = f"kind IN ({X.quoted(*V.DATAFLOW_TYPES)})"
ACTIVITY = f"kind IN ({X.quoted(*V.ACTIVITY_TYPES)})"
REFERENCE = f"kind IN ({X.quoted(*V.REFERENCE_TYPES)})"

# A reference with every field missing; not a null, which would be dropped.
def _missing(**fields: str) -> str:
    """A struct of the fields, each null of its type or the struct given for it."""
    values = (v if v.startswith("named_struct") else f"CAST(NULL AS {v})" for v in fields.values())
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(fields, values, strict=True)) + ")"


_DETAILS = _missing(datasourceType="string", server="string", host="string", database="string", db="string")
_SERVICE = _missing(type="string", url="string", endpoint="string", gatewayId="variant")
EMPTY_REFERENCE = _missing(
    gatewayId="variant", connectionDetails=_DETAILS, type="string", provider="string", url="string", path="string",
    endpoint="string", isCloud="variant", linkedService=_SERVICE,
)


def _sidecar_columns() -> list[str]:
    """Workspace columns from a payload's own sidecar entry ``z.meta``, with defaults for gaps."""
    def field(key: str, default: str, absent: str) -> str:
        return (
            f"CASE WHEN z.meta IS NULL THEN {absent} "
            f"WHEN map_contains_key(z.meta, '{key}') THEN try_element_at(z.meta, '{key}') ELSE {default} END"
        )

    shared, unknown, no = (f"'{x}'" for x in (V.SHARED_CAPACITY, V.UNKNOWN, "false"))
    return [
        "z.ws.id AS workspace_id",
        field("name", "''", "coalesce(z.ws.name, '')") + " AS workspace_name",
        field("kind", unknown, X.lower_or_unknown("z.ws.type")) + " AS workspace_kind",
        "try_element_at(z.meta, 'users') AS workspace_users",
        "try_element_at(z.meta, 'capacity_id') AS capacity_id",
        field("capacity_name", shared, shared) + " AS capacity_name",
        f"try_cast({field('is_dedicated_capacity', no, no)} AS boolean) AS is_dedicated_capacity",
    ]


def explode_workspaces(payloads: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``payload`` rows to one row per workspace: metadata columns and the ``items`` array.

    ``carry`` names columns of the payload rows to keep.
    """
    # The sidecar entry is looked up before the explode, so the map is not copied per row.
    rows = payloads.selectExpr(
        *carry, "explode(arrays_zip(payload.workspaces, "
        "transform(payload.workspaces, w -> try_element_at(payload.workspace_sidecar, w.id)))) AS z"
    )
    return (
        rows.selectExpr(*carry, "named_struct('ws', z.workspaces, 'meta', z.`1`) AS z")
        .filter("z.ws IS NOT NULL")
        .selectExpr(*_sidecar_columns(), "z.ws.items AS items", *carry)
    )


def _with_sidecar(rows: DataFrame, sidecar: DataFrame) -> DataFrame:
    """Replace the workspace metadata of rows by that of a sidecar table (see ``operators.sidecar``)."""
    side = sidecar.selectExpr(
        "workspace_id", "struct(name, kind, users, capacity_id, capacity_name, is_dedicated_capacity) AS _side"
    )
    pick = {
        "workspace_name": "name", "workspace_kind": "kind", "workspace_users": "users",
        "capacity_id": "capacity_id", "capacity_name": "capacity_name",
        "is_dedicated_capacity": "is_dedicated_capacity",
    }
    rest = [c for c in rows.columns if c != "workspace_id" and c not in pick]
    return rows.join(side, "workspace_id", "left").selectExpr(
        "workspace_id",
        *[f"CASE WHEN _side IS NOT NULL THEN _side.{f} ELSE {c} END AS {c}" for c, f in pick.items()],
        *rest,
    )


def explode_items(workspaces: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per item: common metadata, ``kind`` and the uniform ``refs`` array."""
    return (
        workspaces.selectExpr(*META, *carry, "explode(items) AS item")
        .filter("item IS NOT NULL")
        .selectExpr(*META, *carry, "item", f"{X.lower_or_unknown('item.type')} AS kind")
        .selectExpr(*META, *carry, *_item_columns())
    )


def _item_columns() -> list[str]:
    empty = f"CAST(array() AS array<{REFERENCE_DDL}>)"
    generation = X.first_filled("item.generation", "item.properties.generation")
    return [
        "item.id AS item_id", "item.name AS item_name", "kind",
        f"{X.first_filled('item.createdBy', 'item.configuredBy')} AS item_creator",
        "item.modifiedBy AS item_modified_by", "item.modifiedDateTime AS item_modified_date",
        f"CASE WHEN {DATAFLOW} THEN {generation} END AS generation",
        # Kinds without a reading rule yield exactly one placeholder row.
        f"CASE WHEN {SEMANTIC} THEN item.datasources "
        f"WHEN {DATAFLOW} THEN CASE WHEN size(item.sources) > 0 THEN item.sources ELSE item.entities END "
        f"WHEN {ACTIVITY} THEN item.activities "
        f"WHEN {REFERENCE} THEN concat(coalesce(item.connections, {empty}), coalesce(item.lineage, {empty})) "
        f"ELSE array({EMPTY_REFERENCE}) END AS refs",
    ]


def explode_refs(items: DataFrame) -> DataFrame:
    """One row per reference. Items without references give no row."""
    keep = [c for c in items.columns if c != "refs"]
    # coalesce() keeps Spark from inferring a filter that would assemble the array twice.
    return items.selectExpr(*keep, "explode(coalesce(refs, array())) AS ref").filter("ref IS NOT NULL")


def connection_rows(refs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows with workspace and item columns, ``kind`` and one ``ref`` to connection rows."""
    named = (
        f"CASE WHEN {SEMANTIC} THEN ref.connectionDetails.datasourceType "
        f"WHEN {DATAFLOW} THEN {X.first_filled('ref.type', 'ref.provider')} "
        f"WHEN {ACTIVITY} THEN {X.first_filled('ref.linkedService.type', 'ref.type')} "
        f"WHEN {REFERENCE} THEN ref.type END"
    )
    details = "ref.connectionDetails"
    endpoint = (
        f"CASE WHEN {DATAFLOW} THEN {X.first_filled('ref.url', 'ref.path')} "
        f"WHEN {ACTIVITY} THEN {X.first_filled('ref.linkedService.url', 'ref.linkedService.endpoint')} "
        f"WHEN {REFERENCE} THEN {X.first_filled('ref.url', 'ref.endpoint')} END"
    )
    in_cloud = (
        f"CASE WHEN {SEMANTIC} THEN NOT {X.json_truth('ref.gatewayId', False)} "
        f"WHEN {ACTIVITY} THEN NOT {X.json_truth('ref.linkedService.gatewayId', False)} "
        f"WHEN {REFERENCE} THEN {X.json_truth('ref.isCloud', True)} ELSE true END"
    )
    item_type = (
        f"CASE WHEN {SEMANTIC} THEN 'SemanticModel' WHEN {DATAFLOW} THEN 'Dataflow' "
        f"WHEN {ACTIVITY} THEN 'Pipeline' ELSE {X.upper_first('kind')} END"
    )
    shaped = refs.selectExpr(
        *carry, *META, "item_id", "item_name", f"{item_type} AS item_type",
        "item_creator", "item_modified_by", "item_modified_date", "generation",
        f"{X.lower_or_unknown(named)} AS connector",
        f"CASE WHEN {SEMANTIC} THEN {X.first_filled(f'{details}.server', f'{details}.host')} END AS server",
        f"CASE WHEN {SEMANTIC} THEN {X.first_filled(f'{details}.database', f'{details}.db')} END AS database",
        f"{endpoint} AS endpoint",
        f"CASE WHEN {in_cloud} THEN '{V.SCOPE_CLOUD}' ELSE '{V.SCOPE_GATEWAY}' END AS connection_scope",
    )
    derived = {
        "target": X.build_target("server", "database", "endpoint"),
        "cloud": X.cloud_flag("connection_scope", "connector"),
    }
    return shaped.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in CONNECTION_COLUMNS], *carry)


def flatten_payloads(
    payloads: DataFrame,
    sidecar: DataFrame | None = None,
    kinds: tuple[str, ...] | None = None,
    only: DataFrame | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Payloads to the 21-column connection table, duplicates included.

    ``sidecar`` replaces the payload's own workspace metadata. ``kinds`` keeps only items
    of these lower-case types and ``only`` only workspaces with these ``workspace_id``.
    Both joins meet narrow reference rows, never nested items. ``carry`` names columns of
    the payload rows that every connection keeps.
    """
    items = explode_items(explode_workspaces(payloads, carry), carry)
    if kinds is not None:
        items = items.filter(f"kind IN ({X.quoted(*kinds)})")
    refs = explode_refs(items)
    if only is not None:
        refs = refs.join(only.select("workspace_id"), "workspace_id", "left_semi")
    rows = connection_rows(refs, carry)
    return rows if sidecar is None else _with_sidecar(rows, sidecar).select(*rows.columns)


def other_kinds(items: DataFrame) -> DataFrame:
    """Items that none of the reading rules covers."""
    return items.filter(f"NOT ({SEMANTIC} OR {DATAFLOW} OR {ACTIVITY} OR {REFERENCE})")


def flatten_stats(payloads: DataFrame) -> DataFrame:
    """Per item kind: workspaces, items, references and rows produced.

    An item split over several payloads counts once. Counts are taken before the
    references are exploded, so the largest arrays are never expanded.
    """
    items = explode_items(explode_workspaces(payloads))
    per_item = items.groupBy("kind", "workspace_id", "item_id").agg(F.expr("sum(greatest(size(refs), 0)) AS refs"))
    per_workspace = per_item.groupBy("kind", "workspace_id").agg(F.expr("count(1) AS items"), F.expr("sum(refs) AS refs"))
    return per_workspace.groupBy("kind").agg(
        F.expr("count(1) AS workspaces"), F.expr("sum(items) AS items"), F.expr("sum(refs) AS rows")
    )
