"""Flattening rules, on small payloads written by hand."""

import json

import pytest
from pyspark.sql import functions as F

from linkledger.operators import flatten as FL
from linkledger.operators import sidecar as SC
from linkledger.schemas import CONNECTION_COLUMNS
from linkledger.sources import payloads as P


def docs(spark, *roots):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in roots]
    return spark.createDataFrame([(f"f{i}.json", t) for i, t in enumerate(texts)], "path string, text string")


def flat(spark, *roots):
    return [r.asDict() for r in FL.flatten_payloads(P.payload_roots(docs(spark, *roots))).collect()]


def one_item(**item):
    item.setdefault("id", "i")
    return {"workspaces": [{"id": "w", "name": "W", "type": "Workspace", "items": [item]}]}


def connections(spark, **item):
    keys = ("item_type", "connector", "server", "database", "endpoint", "connection_scope", "cloud", "generation")
    return sorted((tuple(r[k] for k in keys) for r in flat(spark, one_item(**item))), key=repr)


def test_schema_is_fixed_even_when_all_null(spark):
    df = FL.flatten_payloads(P.payload_roots(docs(spark, one_item(type="Report"))))
    assert df.columns == CONNECTION_COLUMNS
    assert dict(df.dtypes)["generation"] == "string"


@pytest.mark.parametrize("details, gateway, expected", [
    ({"datasourceType": "Sql", "server": "s", "database": "d"}, None, ("sql", "s", "d", "Cloud", True)),
    ({"datasourceType": "Sql", "server": "", "host": "h", "db": "x"}, None, ("sql", "h", "x", "Cloud", True)),
    ({}, None, ("unknown", None, None, "Cloud", True)),
    (None, None, ("unknown", None, None, "Cloud", True)),
    ({"datasourceType": ""}, None, ("", None, None, "Cloud", True)),
    ({"datasourceType": "Snowflake"}, "g", ("snowflake", None, None, "OnPremViaGateway", True)),
    ({"datasourceType": "Sql"}, "g", ("sql", None, None, "OnPremViaGateway", False)),
    ({"datasourceType": "Sql"}, "", ("sql", None, None, "Cloud", True)),
    ({"datasourceType": "Sql"}, 0, ("sql", None, None, "Cloud", True)),
    ({"datasourceType": "Sql"}, False, ("sql", None, None, "Cloud", True)),
    ({"datasourceType": "Sql", "server": 7}, "g", ("sql", "7", None, "OnPremViaGateway", False)),
])
def test_semantic_model(spark, details, gateway, expected):
    ds = {"connectionDetails": details, "gatewayId": gateway}
    got = connections(spark, type="Dataset", datasources=[ds])
    assert [(r[1], r[2], r[3], r[5], r[6]) for r in got] == [expected]
    assert got[0][0] == "SemanticModel"


def test_semantic_model_without_sources_has_no_row(spark):
    assert flat(spark, one_item(type="SemanticModel", datasources=[])) == []
    assert flat(spark, one_item(type="SemanticModel", datasources=None)) == []
    assert flat(spark, one_item(type="SemanticModel")) == []


def test_dataflow_uses_entities_when_sources_are_empty(spark):
    got = connections(
        spark, type="Dataflow", sources=[], entities=[{"type": "", "provider": "ADLS", "path": "/p"}],
        properties={"generation": 2},
    )
    assert got == [("Dataflow", "adls", None, None, "/p", "Cloud", True, "2")]


def test_dataflow_own_generation_wins(spark):
    got = connections(spark, type="dataflow", sources=[{"type": "Web", "url": "u", "path": "p"}], generation=1,
                      properties={"generation": 2})
    assert got == [("Dataflow", "web", None, None, "u", "Cloud", True, "1")]


def test_activity_without_linked_service(spark):
    got = connections(spark, type="Pipeline", activities=[
        {"type": "Copy"}, {"type": "Copy", "linkedService": {"type": "S3", "endpoint": "e", "gatewayId": "g"}},
    ])
    assert got == [
        ("Pipeline", "copy", None, None, None, "Cloud", True, None),
        ("Pipeline", "s3", None, None, "e", "OnPremViaGateway", True, None),
    ]


@pytest.mark.parametrize("flag, scope", [
    ({}, "Cloud"), ({"isCloud": None}, "OnPremViaGateway"), ({"isCloud": False}, "OnPremViaGateway"),
    ({"isCloud": True}, "Cloud"), ({"isCloud": 0}, "OnPremViaGateway"), ({"isCloud": ""}, "OnPremViaGateway"),
    ({"isCloud": "false"}, "Cloud"), ({"isCloud": []}, "OnPremViaGateway"), ({"isCloud": {"a": 1}}, "Cloud"),
    ({"isCloud": 0.0}, "OnPremViaGateway"), ({"isCloud": 2}, "Cloud"),
])
def test_is_cloud_truth(spark, flag, scope):
    got = connections(spark, type="Notebook", connections=[{"type": "File", "url": "u", **flag}])
    assert [(r[0], r[5], r[6]) for r in got] == [("Notebook", scope, scope == "Cloud")]


def test_connections_and_lineage_are_both_read(spark):
    got = connections(spark, type="LAKEHOUSE", connections=[{"type": "A"}], lineage=[{"type": "B", "endpoint": "e"}])
    assert [(r[0], r[1], r[4]) for r in got] == [("Lakehouse", "a", None), ("Lakehouse", "b", "e")]


@pytest.mark.parametrize("type_, shown", [("report", "Report"), (None, "Unknown"), ("big Dashboard", "Big dashboard")])
def test_other_kinds_give_one_placeholder(spark, type_, shown):
    assert connections(spark, type=type_, datasources=[{}, {}]) == [
        (shown, "unknown", None, None, None, "Cloud", True, None)
    ]


def test_target(spark):
    def target(**details):
        ds = [{"connectionDetails": details}]
        return flat(spark, one_item(type="dataset", datasources=ds))[0]["target"]

    assert target(server="s", database="d") == "Server: s | Database: d"
    assert target(database="d") == "Database: d"
    assert target() is None
    nb = flat(spark, one_item(type="notebook", lineage=[{"url": "u"}]))
    assert nb[0]["target"] == "Endpoint: u"


def test_item_metadata(spark):
    row = flat(spark, one_item(type="report", createdBy="", configuredBy="c", modifiedBy="m", modifiedDateTime="t"))[0]
    assert (row["item_creator"], row["item_modified_by"], row["item_modified_date"]) == ("c", "m", "t")


def test_payload_sidecar_and_its_gaps(spark):
    ws = [{"id": i, "name": n, "type": t, "items": [{"id": "i", "type": "report"}]} for i, n, t in
          (("a", "A", "Workspace"), ("b", None, None), ("c", "C", "X"))]
    side = {"a": {"name": "AA", "kind": "k", "users": "u", "capacity_id": "c1", "capacity_name": "Cap",
                  "is_dedicated_capacity": True}, "c": {"users": None}}
    rows = {r["workspace_id"]: r for r in flat(spark, {"workspaces": ws, "workspace_sidecar": side})}
    meta = ["workspace_name", "workspace_kind", "workspace_users", "capacity_id", "capacity_name", "is_dedicated_capacity"]
    assert [rows["a"][m] for m in meta] == ["AA", "k", "u", "c1", "Cap", True]
    assert [rows["b"][m] for m in meta] == ["", "unknown", None, None, "Shared", False]
    assert [rows["c"][m] for m in meta] == ["", "unknown", None, None, "Shared", False]


def test_sidecar_table_replaces_payload_metadata(spark):
    payloads = P.payload_roots(docs(spark, one_item(type="report")))
    side = SC.build_sidecar(spark.createDataFrame(
        [("w", "Z", None, "cap-12345678", None, True, None)],
        "id string, name string, type string, capacityId string, capacityName string, isOnDedicatedCapacity boolean, "
        "users array<struct<emailAddress string, identifier string, workspaceUserAccessRight string, "
        "groupUserAccessRight string>>"))
    row = FL.flatten_payloads(payloads, side).first()
    assert (row.workspace_name, row.workspace_kind, row.capacity_name) == ("Z", "unknown", "Capacity_cap-1234")


def users_frame(spark, users):
    u = "struct<emailAddress string, identifier string, workspaceUserAccessRight string, groupUserAccessRight string>"
    return spark.createDataFrame([(users,)], f"users array<{u}>")


@pytest.mark.parametrize("users, expected", [
    ([("a", None, "Viewer", None)], None),
    ([], None),
    (None, None),
    ([(f"a{i}", None, "Admin", None) for i in range(7)], "a0, a1, a2, a3, a4, a5, a6"),
    ([(None, "id", "Admin", None), ("", "id2", "Member", None)], "id, id2"),
    ([(None, None, "Admin", None), ("b", None, None, "Member")], "b"),
])
def test_owners(spark, users, expected):
    assert users_frame(spark, users).selectExpr(f"{SC.owners('users')} AS o").first().o == expected
    first = users_frame(spark, users).selectExpr(f"{SC.owners('users', 1)} AS o").first().o
    assert first == (expected and expected.split(", ")[0])


@pytest.mark.parametrize("cap_id, name, dedicated, expected", [
    ("12345678-9", None, True, "Capacity_12345678"), ("c", "N", True, "N"), (None, "N", True, "Shared"),
    ("c", "N", False, "Shared"), ("c", "N", None, "Shared"), ("", "N", True, "Shared"),
])
def test_capacity_label(spark, cap_id, name, dedicated, expected):
    df = spark.createDataFrame([(cap_id, name, dedicated)], "i string, n string, d boolean")
    assert df.selectExpr(f"{SC.capacity_label('i', 'n', 'd')} AS l").first().l == expected


def test_backfill_adds_only_missing_workspaces(spark):
    side = SC.build_sidecar(spark.createDataFrame([("a", "A", "T", "c", "C", True)],
        "id string, name string, type string, capacityId string, capacityName string, isOnDedicatedCapacity boolean"),
        profile="listing")
    asked = spark.createDataFrame([("a", "x", "T"), ("b", None, ""), (None, "n", "T")], "id string, name string, type string")
    rows = {r.workspace_id: tuple(r)[1:] for r in SC.backfill(side, asked).collect()}
    assert rows == {"a": ("A", "workspace", None, "c", "C", True), "b": ("", "unknown", None, None, "Shared", False)}


def test_sidecar_of_the_latest_scan(spark):
    ws = docs(spark, {"workspaces": [{"id": "w", "name": "zz-old", "type": "T"}]}).withColumn("scan", F.lit("1")).unionByName(
        docs(spark, {"workspaces": [{"id": "w", "name": "aa-new", "type": "T"}]}).withColumn("scan", F.lit("2")))
    got = SC.build_sidecar(SC.payload_workspaces(P.payload_roots(ws))).collect()
    assert [(r.workspace_id, r.name) for r in got] == [("w", "aa-new")]
