"""Direction, activity, capacity, plan, request and source rules."""

import pytest
from pyspark.sql import functions as F

from linkledger.operators import activity as A
from linkledger.operators import capacity as C
from linkledger.operators import direction as D
from linkledger.operators import requests as Q
from linkledger.operators import scanplan as N
from linkledger.sinks import tables as TB
from linkledger.sources import workspaces as W


@pytest.mark.parametrize("con, server, endpoint, expected", [
    ("Snowflake", None, None, "outbound"), ("fabriclakehouse", "x.windows.net", None, "internal"),
    ("sql", "x.database.windows.net", None, "outbound"), ("sql", "onelake.x.windows.net", None, "unknown"),
    (None, None, None, "unknown"), ("forestry", None, None, "outbound"), ("sql", None, "https://a.azure.com", "outbound"),
    ("sql", "my-fabric", "https://a.azure.com", "unknown"), ("", "", "", "unknown"), ("sql", "A.SALESFORCE.COM", None, "outbound"),
    ("sql", "xwindowsxnet", None, "unknown"),
])
def test_direction(spark, con, server, endpoint, expected):
    df = spark.createDataFrame([(con, server, endpoint)], "connector string, server string, endpoint string")
    assert D.classify(df).first().direction == expected


def events(spark, *rows):
    return A.unnest_pages(spark.createDataFrame([('{"activityEventEntities": [' + ", ".join(rows) + "]}",), ('{"continuationToken": "t"}',)], "text string"))


def event(agent, activity="ViewReport", **more):
    import json
    return json.dumps({"Activity": activity, "CreationTime": "2024-01-30T10:00:00.0000000Z", **({"UserAgent": agent} if agent is not False else {}), **more})


def test_inbound_agents_and_success(spark):
    e = events(spark, event("Mozilla/5.0"), event(""), event(None), event(False), event("python-requests", UserId="a"),
               event("curl", "GetTile", IsSuccess=False), event("curl", "CreateDataset"), event("curl", "GetTile", UserId="a"))
    got = sorted((r.activity, r.user_agent, r.is_success) for r in A.inbound(e).collect())
    assert got == [("GetTile", "curl", False), ("GetTile", "curl", True), ("ViewReport", "python-requests", True)]
    s = A.summary(A.inbound(e)).first()
    assert (s.calls, s.users, s.ips) == (3, 1, 0)
    assert [tuple(r) for r in A.top_activities(A.inbound(e)).collect()] == [("GetTile", 2), ("ViewReport", 1)]
    assert A.summary(A.inbound(e), approximate=True).first().users == 1


def test_window_is_half_open_and_tiles_cover_it(spark):
    times = ["2024-01-29T00:00:00Z", "2024-01-30T23:59:59Z", "2024-01-31T00:00:00Z", "junk"]
    e = spark.createDataFrame([(t, "GetTile") for t in times], "CreationTime string, Activity string")
    end = F.lit("2024-01-31").cast("timestamp")
    assert A.in_window(e, end, 2).count() == 2
    assert A.in_window(e, end, 2, "ViewReport").count() == 0
    assert [(r.tile, r.events) for r in A.day_tiles(e, end, 3).orderBy("tile").collect()] == [(0, 0), (1, 1), (2, 1)]


WS = "id string, capacityId string, isOnDedicatedCapacity boolean"


def test_capacity_groups_filters_and_order(spark):
    ws = spark.createDataFrame([("1", "cap-1", True), ("2", "cap-1", True), ("3", "cap-2", True), ("4", None, False), ("5", "cap-3", False), ("6", None, True)], WS)
    keyed = C.with_capacity_key(ws)
    counts = {r.capacity_key: r.workspaces for r in C.distribution(keyed).collect()}
    assert counts == {"cap-1": 2, "cap-2": 1, "shared": 3}
    assert {r.id for r in C.select_capacities(keyed, ["cap-1", "shared", "nope"], ["shared"]).collect()} == {"1", "2"}
    assert {r.id for r in C.select_capacities(keyed, exclude=["shared"]).collect()} == {"1", "2", "3"}
    assert [r.capacity_key for r in C.unknown_capacities(keyed, ["cap-1", "nope"]).collect()] == ["nope"]
    order = lambda p: [r.capacity_key for r in C.ordered(C.distribution(keyed).select("capacity_key", "workspaces"), p).orderBy("position").collect()]
    assert order(None) == ["shared", "cap-1", "cap-2"]
    assert order(["cap-2", "nope", "cap-1"]) == ["cap-2", "cap-1", "shared"]
    flagless = C.with_capacity_key(ws.drop("isOnDedicatedCapacity"))
    assert flagless.filter("capacity_key = 'shared'").count() == 2


def test_batches_of_one_hundred(spark):
    ws = spark.range(350).selectExpr("concat('ws-', id) AS id").unionByName(spark.createDataFrame([(None,), ("",)], "id string"))
    plan = N.plan_batches(ws, max_batches_per_hour=2)
    sizes = [r["count"] for r in plan.groupBy("batch_no").count().orderBy("batch_no").collect()]
    assert sizes == [100, 100, 100, 50]
    assert sorted(r.seq for r in plan.collect()) == list(range(350))
    assert [tuple(r) for r in plan.select("batch_no", "chunk_no").distinct().orderBy("batch_no").collect()] == [(0, 0), (1, 0), (2, 1), (3, 1)]
    done = spark.createDataFrame([(1,), (1,), (3,)], "batch_no int")
    assert N.remaining(plan, done).select("batch_no").distinct().count() == 2
    p = N.progress(plan, done, 2).first()
    assert (p.total_batches, p.completed, p.remaining, p.completed_pct, p.hours_left) == (4, 2, 2, 50.0, 1.0)


def test_estimate_of_a_large_tenant(spark):
    e = N.estimate(spark.range(247_000).selectExpr("CAST(id AS string) AS id"), 250).first()
    assert (e.batches, e.calls, e.whole_hours) == (2470, 19760.0, 10)


@pytest.mark.parametrize("ok, limited, status, parallel, safe", [
    (5, 0, "clear", 3, True), (3, 1, "light", 1, True), (1, 1, "heavy", 1, False), (2, 2, "heavy", 1, False), (3, 2, "moderate", 2, True), (2, 1, "moderate", 2, True),
])
def test_contention(spark, ok, limited, status, parallel, safe):
    log = spark.createDataFrame([(200,)] * ok + [(429,)] * limited, "status int")
    r = Q.contention_status(log).first()
    assert (r.status, r.recommended_parallel, r.safe_to_proceed) == (status, parallel, safe)


@pytest.mark.parametrize("calls, band", [(100, "healthy"), (400, "moderate"), (480, "warning")])
def test_request_rate(spark, calls, band):
    log = spark.range(calls).selectExpr(f"timestamp_micros(CAST(id * 3600e6 / {calls - 1} AS bigint)) AS ts")
    r = Q.request_rate(log).first()
    assert (r.calls, r.elapsed_minutes, r.rate_per_hour, r.band) == (calls, 60.0, float(calls), band)
    assert Q.request_rate(log.limit(1)).first().rate_per_hour == 0.0


def test_personal_filter_keeps_unknown_types(spark):
    df = spark.createDataFrame([("Workspace",), ("PersonalGroup",), ("personalgroup",), (None,)], "type string")
    assert W.exclude_personal(df, "type").count() == 2
    assert W.exclude_personal(df, "absent").count() == 4
    assert W.exclude_personal(df, "type", ("PersonalGroup", "workspace")).count() == 1


def test_workspace_source(spark, tmp_path):
    df = spark.createDataFrame([("a", "PersonalGroup"), (None, "T"), ("b", None)], "workspace_id string, workspace_type string")
    path = f"{tmp_path}/ws.parquet"
    df.write.parquet(path)
    got = W.read_workspace_source(spark, "ws", curated_dir=str(tmp_path), include_personal=False)
    assert [tuple(r) for r in got.collect()] == [("b", None, None, None)]
    assert W.read_workspace_source(spark, path).count() == 2
    assert W.read_workspace_source(spark, f"{tmp_path}/absent") is None
    df.drop("workspace_id").write.parquet(f"{tmp_path}/bad.parquet")
    assert W.read_workspace_source(spark, "bad", curated_dir=str(tmp_path)) is None
    df.limit(0).write.parquet(f"{tmp_path}/none.parquet")
    assert W.read_workspace_source(spark, "none", curated_dir=str(tmp_path)) is None
    for blank in ("", "  "):
        with pytest.raises(ValueError):
            W.read_workspace_source(spark, blank)
    df.createOrReplaceTempView("ws_view")
    assert W.read_workspace_source(spark, "ws_view").count() == 2


def test_lookback(spark):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    shown = lambda **k: spark.range(1).select(F.date_format(W.lookback_start(now, **k), "dd HH:mm")).first()[0]
    assert [shown(), shown(hours=0.5), shown(days=1.5), shown(hours=2, days=9)] == ["30 00:00", "30 23:30", "29 12:00", "30 22:00"]


@pytest.mark.parametrize("name", ["t; DROP TABLE x", "a b", "a-b", "a'b", "", "t\n", "x/*", "täble"])
def test_bad_identifiers(name):
    with pytest.raises(ValueError):
        TB.check_identifier(name)


@pytest.mark.parametrize("name", ["t", "db.t", "a_1.B_2"])
def test_good_identifiers(name):
    assert TB.check_identifier(name) == name
