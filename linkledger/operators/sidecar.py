"""Workspace sidecar: the small per-workspace dimension joined to every connection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X

SIDECAR_COLUMNS = [
    "workspace_id", "name", "kind", "users", "capacity_id", "capacity_name", "is_dedicated_capacity",
]


def owners(users: str, limit: int | None = None) -> str:
    """Owners of a workspace, or its first ``limit``, comma-separated; null when there are none.

    Either access-right field is accepted. Owners without any address are dropped before
    the limit is taken.
    """
    rights = X.quoted(*V.OWNER_RIGHTS)
    entitled = f"filter({users}, u -> u.workspaceUserAccessRight IN ({rights}) OR u.groupUserAccessRight IN ({rights}))"
    address = X.first_filled("u.emailAddress", "u.identifier")
    names = f"filter(transform({entitled}, u -> {address}), n -> n IS NOT NULL)"
    shown = f"slice({names}, 1, {int(limit)})" if limit else names
    return f"CASE WHEN size({names}) > 0 THEN array_join({shown}, ', ') END"


def capacity_label(capacity_id: str, capacity_name: str, dedicated: str) -> str:
    """Display name of a workspace's capacity."""
    short = f"concat('Capacity_', left({capacity_id}, 8))"
    return (
        f"CASE WHEN {dedicated} AND {X.is_filled(capacity_id)} THEN {X.first_filled(capacity_name, short)} "
        f"ELSE '{V.SHARED_CAPACITY}' END"
    )


_DEDICATED = "coalesce(isOnDedicatedCapacity, false)"
_NONE = "CAST(NULL AS string)"


def build_sidecar(workspaces: DataFrame, profile: str = "full") -> DataFrame:
    """Sidecar rows from workspace rows shaped like the payload's workspace object.

    Profiles: ``full`` takes everything from the payload; ``incremental`` and ``by_id``
    carry no capacity; ``listing`` comes from a workspace list without users.
    A workspace seen several times gives one row, that of its latest ``scan`` where the rows
    have one.
    """
    if profile == "full":
        label = capacity_label("capacityId", "capacityName", _DEDICATED)
        rest = [X.kind_of("type"), owners("users"), "capacityId", label, _DEDICATED]
    elif profile in ("incremental", "by_id"):
        rest = [X.kind_of("type"), owners("users"), _NONE, f"'{V.SHARED_CAPACITY}'", "false"]
    elif profile == "listing":
        label = X.first_filled("capacityName", f"'{V.SHARED_CAPACITY}'")
        rest = ["'workspace'", _NONE, "capacityId", label, _DEDICATED]
    else:
        raise ValueError(f"unknown sidecar profile {profile!r}")
    columns = zip(["id", "coalesce(name, '')", *rest], SIDECAR_COLUMNS)
    scan = "scan" if "scan" in workspaces.columns else "''"
    rows = workspaces.filter(X.is_filled("id")).selectExpr(*[f"{c} AS {n}" for c, n in columns], f"{scan} AS _scan")
    # max() of a struct combines before the shuffle, however often a workspace repeats.
    best = rows.groupBy("workspace_id").agg(F.expr(f"max(struct(_scan, {', '.join(SIDECAR_COLUMNS[1:])})) AS m"))
    return best.select("workspace_id", *[f"m.{c}" for c in SIDECAR_COLUMNS[1:]])


def payload_workspaces(payloads: DataFrame) -> DataFrame:
    """The payload's workspace objects as rows, without their items, with the ``scan`` they are from."""
    scan = "scan" if "scan" in payloads.columns else "'' AS scan"
    rows = payloads.selectExpr(scan, "explode(payload.workspaces) AS w").filter("w IS NOT NULL")
    return rows.select(
        "scan", "w.id", "w.name", "w.type", "w.capacityId", "w.capacityName", "w.isOnDedicatedCapacity", "w.users"
    )


def backfill(sidecar: DataFrame, requested: DataFrame) -> DataFrame:
    """Add defaults for requested workspaces (``id, name, type``) the scan did not return."""
    missing = (
        requested.filter(X.is_filled("id"))
        .join(sidecar.selectExpr("workspace_id AS id"), "id", "left_anti")
        .selectExpr(
            "id AS workspace_id", "coalesce(name, '') AS name", f"{X.kind_of('type')} AS kind", f"{_NONE} AS users",
            f"{_NONE} AS capacity_id", f"'{V.SHARED_CAPACITY}' AS capacity_name", "false AS is_dedicated_capacity",
        )
    )
    return sidecar.select(*SIDECAR_COLUMNS).unionByName(missing)


def lookup(workspaces: DataFrame, sidecar: DataFrame) -> DataFrame:
    """Workspace rows (``id, name, type``) with their sidecar values, defaults where absent."""
    side = sidecar.selectExpr("workspace_id AS id", f"struct({', '.join(SIDECAR_COLUMNS[1:])}) AS s")
    defaults = {
        "name": "coalesce(name, '')", "kind": X.lower_or_unknown("type"), "users": "NULL", "capacity_id": "NULL",
        "capacity_name": f"'{V.SHARED_CAPACITY}'", "is_dedicated_capacity": "false",
    }
    return workspaces.join(side, "id", "left").selectExpr(
        "id AS workspace_id", *[f"CASE WHEN s IS NOT NULL THEN s.{c} ELSE {d} END AS {c}" for c, d in defaults.items()]
    )
