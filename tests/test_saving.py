"""Snapshots, tables, raw landing, jobs and the stream."""

import hashlib
import json
import os

import pytest
from test_flatten import docs, one_item
from test_merge import frame, names, row

from linkledger.operators import activity as A
from linkledger.operators import flatten as FL
from linkledger.plans import jobs as J
from linkledger.schemas import CONNECTION_SCHEMA
from linkledger.sinks import scratch
from linkledger.sinks import snapshots as S
from linkledger.sinks import tables as TB
from linkledger.sources import inventory as I
from linkledger.sources import payloads as P
from linkledger.streaming import ingest as ST
from pyspark.sql import functions as F


def test_snapshot_versions_and_lost_writes(spark, tmp_path):
    base = f"{tmp_path}/t"
    assert S.read_snapshot(spark, base, CONNECTION_SCHEMA).count() == 0
    for i in range(4):
        path, n = S.write_snapshot(spark.range(i), base)
        assert n == i and path.endswith(f"v{i + 1:08d}")
    assert sorted(os.listdir(base)) == [f"v0000000{i}" for i in range(1, 5)]
    os.makedirs(f"{base}/v00000005")  # a writer that died
    assert S.current_path(spark, base).endswith("v00000004")
    path, _ = S.write_snapshot(spark.range(9), base)
    assert path.endswith("v00000006") and spark.read.parquet(S.current_path(spark, base)).count() == 9
    S.vacuum(spark, base)
    assert sorted(os.listdir(base)) == ["v00000004", "v00000005", "v00000006"]


def test_notes_belong_to_their_version(spark, tmp_path):
    base = f"{tmp_path}/t"
    assert S.read_note(spark, base) == {}
    S.write_snapshot(spark.range(1), base, note={"x": 1})
    S.write_snapshot(spark.range(2), base)
    assert S.read_note(spark, base) == {"x": 1}
    os.makedirs(f"{base}/notes/v00000003")  # the note of a version that was never finished
    assert S.read_note(spark, base) == {"x": 1}
    S.write_snapshot(spark.range(2), base, note={"x": 2})
    assert S.read_note(spark, base) == {"x": 2}


def test_a_registered_table_outlives_later_saves(spark, tmp_path):
    base = f"{tmp_path}/t"
    TB.save_inventory(frame(spark, row()), base, table="inv_kept")
    for i in range(3):
        TB.save_inventory(frame(spark, row(ws=f"v{i}")), base, mode="merge")
    S.vacuum(spark, base, keep=1, tables=("inv_kept",))
    assert spark.table("inv_kept").count() == 1 and I.read_inventory(spark, base).count() == 4
    assert sorted(d for d in os.listdir(base) if d.startswith("v")) == ["v00000001", "v00000004"]


def test_failed_merge_keeps_the_table(spark, tmp_path):
    base = f"{tmp_path}/t"
    TB.save_inventory(frame(spark, row()), base)
    broken = frame(spark, row(ws="v")).withColumn("item_name", F.expr("CAST(raise_error('lost') AS string)"))
    with pytest.raises(Exception):
        TB.save_inventory(broken, base, mode="merge")
    assert I.read_inventory(spark, base).count() == 1
    assert TB.save_inventory(frame(spark, row(ws="v")), base, mode="append") == 2


def test_save_registers_and_refreshes_the_table(spark, tmp_path):
    base = f"{tmp_path}/it's"
    assert TB.save_inventory(frame(spark, row(), row(con="SQL")), base, table="inv_test") == 1
    assert TB.save_inventory(frame(spark, row(ws="v")), base, table="inv_test", mode="merge") == 2
    assert I.read_inventory(spark, "inv_test").count() == 2
    with pytest.raises(ValueError):
        TB.save_inventory(frame(spark, row()), base, table="x; drop")
    with pytest.raises(ValueError):
        TB.save_inventory(frame(spark, row()), base, mode="replace")
    TB.create_table_as(I.read_inventory(spark, "inv_test").select("workspace_id"), "ws_derived")
    assert spark.table("ws_derived").count() == 2


def test_plain_parquet_is_readable_as_inventory(spark, tmp_path):
    frame(spark, row()).write.parquet(f"{tmp_path}/plain")
    assert I.read_inventory(spark, f"{tmp_path}/plain").count() == 1


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch.scratch_dir(spark, "x"), scratch.scratch_dir(spark, "x")
    assert a != b and a.startswith(base)


def land(path, name, payload):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump(payload, f)


def test_directory_and_single_scan_jobs(spark, tmp_path):
    raw, cur = f"{tmp_path}/raw", f"{tmp_path}/cur"
    land(raw, "s1.json", one_item(id="a", type="report"))
    land(raw, "s2.json", [one_item(id="b", type="report"), 1])
    (tmp_path / "raw" / "bad.json").write_text("{")
    assert J.scan_directory(spark, raw, cur) == 2
    land(raw, "s3.json", {"workspaces": [{"id": "w", "name": "N", "type": "T", "users": [
        {"emailAddress": "o", "groupUserAccessRight": "Admin"}], "items": [{"id": "c", "type": "report"}]}]})
    assert J.scan_by_id(spark, raw, "s3", cur, table="inv_jobs") == 3
    row_ = spark.table("inv_jobs").filter("item_id = 'c'").first()
    assert (row_.workspace_users, row_.workspace_kind, row_.capacity_name) == ("o", "t", "Shared")
    assert J.scan_by_id(spark, raw, "s1", cur, merge_with_existing=False) == 1


def test_incremental_job(spark, tmp_path):
    now = F.lit("2024-01-31").cast("timestamp")
    ws = spark.createDataFrame([(f"w{i}", f"W{i}", "Workspace", "2024-01-30 20:00:00") for i in range(7)] + [("old", "O", "T", "2023-01-01 00:00:00")],
                               "id string, name string, type string, modified string").withColumn("modified", F.col("modified").cast("timestamp"))
    def scan(suffix, ids):
        return docs(spark, {"workspaces": [{"id": i, "items": [{"id": "a", "name": suffix, "type": "report"}]} for i in ids]})
    ids = [f"w{i}" for i in range(7)] + ["old"]
    args = dict(workspaces=ws, since=F.lit("2024-01-30").cast("timestamp"), as_of=now, curated=f"{tmp_path}/c", hashes=f"{tmp_path}/h")
    assert J.incremental_update(scan("one", ids), scan_time="2024-01-30T23:00:00+00:00", **args) == 7
    assert I.read_fingerprints(spark, f"{tmp_path}/h").count() == 7
    # All seven were scanned an hour ago, so a second run has nothing to do.
    assert J.incremental_update(scan("two", ids), scan_time="2024-01-31T00:00:00+00:00", **args) == 0
    assert J.incremental_update(scan("three", ids), scan_time="x", skip_recent=False, **args) == 7
    args["curated"] = f"{tmp_path}/parts"
    assert J.incremental_update(scan("four", ids), scan_time="y", skip_recent=False, partitions=4, **args) == 7
    assert {r.item_name for r in I.read_inventory(spark, f"{tmp_path}/c").collect()} == {"three"}
    assert {r.item_name for r in I.read_inventory(spark, f"{tmp_path}/parts").collect()} == {"four"}


@pytest.mark.parametrize("partitions", [None, 4])
def test_latest_scan_replaces_and_empties(spark, tmp_path, partitions):
    ws = spark.createDataFrame([("w", "W", "T"), ("e", "E", "T"), ("x", "X", "T")], "id string, name string, type string").withColumn(
        "modified", F.lit("2024-01-30").cast("timestamp"))
    args = dict(workspaces=ws, since=F.lit("2024-01-29").cast("timestamp"), as_of=F.lit("2024-01-31").cast("timestamp"),
                curated=f"{tmp_path}/c", hashes=f"{tmp_path}/h", skip_recent=False, partitions=partitions)

    def scan(*dated):
        frames = [docs(spark, {"workspaces": [{"id": i, "items": [{"id": n, "name": n, "type": "report"} for n in names]} for i, names in of.items()]})
                  .withColumn("scan", F.lit(day)) for day, of in dated]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def state():
        inv = sorted((r.workspace_id, r.item_id) for r in I.read_inventory(spark, f"{tmp_path}/c").collect())
        return inv, {r.workspace_id: (r.connection_hash, r.last_scan_time) for r in I.read_fingerprints(spark, f"{tmp_path}/h").collect()}

    first = scan(("1", {"w": ["zz-new", "gone"], "e": ["a", "b"], "x": ["q"]}))
    J.incremental_update(first, scan_time="t1", **args)
    _, prints = state()
    J.incremental_update(scan(("1", {"w": ["aa-old", "gone"]}), ("2", {"w": ["zz-new"], "e": []})), scan_time="t2", **args)
    inv, now = state()
    assert inv == [("w", "zz-new"), ("x", "q")]
    assert now["x"] == prints["x"] and now["w"][0] != prints["w"][0] and now["w"][1] == now["e"][1] == "t2"
    assert now["e"][0] == hashlib.sha256(b"").hexdigest()
    if partitions:
        J.incremental_update(scan(("3", {"w": [], "x": []})), scan_time="t3", **args)
        assert state()[0] == []


def test_direction_analysis_is_saved(spark, tmp_path):
    inv = frame(spark, row(con="snowflake"))
    ev = spark.createDataFrame([("2024-01-30T00:00:00Z", "GetTile", "curl")], "CreationTime string, Activity string, UserAgent string")
    for c in ("UserId", "ClientIP", "WorkspaceId", "WorkspaceName", "DatasetId", "DatasetName", "ReportId", "ReportName"):
        ev = ev.withColumn(c, F.lit(None).cast("string"))
    ev = ev.withColumn("IsSuccess", F.lit(None).cast("boolean"))
    classified, inbound = J.analyse_direction(inv, ev, F.lit("2024-01-31").cast("timestamp"), 30, str(tmp_path))
    assert classified.first().direction == "outbound" and inbound.count() == 1
    assert spark.read.parquet(S.current_path(spark, f"{tmp_path}/inbound_api_activity/parquet")).count() == 1
    assert TB.read_csv(spark, f"{tmp_path}/connections_with_direction/csv", classified.schema).first().direction == "outbound"
    assert J.analyse_direction(inv)[1] is None


def test_raw_landing_round_trip(spark, tmp_path):
    payload = one_item(id="n", type="notebook", connections=[{"type": "a"}, {"type": "b", "isCloud": None}])
    payloads = P.payload_roots(docs(spark, payload, [payload, payload]))
    before = sorted(map(tuple, FL.flatten_payloads(payloads).collect()), key=repr)
    TB.land_payloads(payloads.selectExpr("'full' AS scan_kind", "'2024-01-30' AS scan_date", "payload"), f"{tmp_path}/raw")
    TB.land_payloads(payloads.selectExpr("'full' AS scan_kind", "'2023-01-30' AS scan_date", "payload"), f"{tmp_path}/raw")
    read = P.read_payload_text(spark, f"{tmp_path}/raw", per_line=True, since="2024-01-01")
    after = FL.flatten_payloads(P.payload_roots(read)).collect()
    assert sorted(map(tuple, after), key=repr) == before
    assert {r.scan for r in read.collect()} == {"2024-01-30"}
    plan = FL.flatten_payloads(P.payload_roots(read))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scan_date" in plan


def test_events_are_landed_and_pruned_by_date(spark, tmp_path):
    times = ["2024-01-30T00:00:00Z", "2024-01-31T23:30:00-05:00", "2024-01-01T00:00:00Z", "never", None]
    columns = ["UserId", "ClientIP", "UserAgent", "WorkspaceId", "WorkspaceName", "DatasetId", "DatasetName", "ReportId", "ReportName"]
    ev = spark.createDataFrame([(t, "GetTile" if i else "Other") for i, t in enumerate(times)], "CreationTime string, Activity string")
    ev = ev.selectExpr("*", *[f"CAST(NULL AS string) AS {c}" for c in columns], "CAST(NULL AS boolean) AS IsSuccess")
    A.land_events(ev, f"{tmp_path}/ev")
    end = F.lit("2024-02-01 12:00:00").cast("timestamp")
    assert sorted(r.CreationTime for r in A.read_events(spark, f"{tmp_path}/ev", end, 5).collect()) == times[:2]
    got = A.read_events(spark, f"{tmp_path}/ev", end, 5, activity="GetTile")
    assert [r.CreationTime for r in got.collect()] == times[1:2] and set(got.columns) == set(ev.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(created_at)" in plan


def test_csv_gives_back_what_it_got(spark, tmp_path):
    odd = ["", None, "a\nb", 'q"u"o', "c,d", " lead", "trail ", "\\", '\\"', "\r\n", "é", '""', "null", "\t"]
    df = spark.createDataFrame([(i, x, "end") for i, x in enumerate(odd)], "i int, x string, y string")
    TB.save_csv(df, f"{tmp_path}/csv")
    assert sorted(map(tuple, TB.read_csv(spark, f"{tmp_path}/csv", df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_jobs_write_rejects(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    land(raw, "s1.json", [one_item(id="a", type="report"), 5])
    (tmp_path / "raw" / "bad.json").write_text("{")
    with open(tmp_path / "raw" / "huge.json", "wb") as f:
        f.truncate(2 * 1024**3)
    assert J.scan_directory(spark, raw, f"{tmp_path}/cur", rejects=f"{tmp_path}/rej") == 1
    got = sorted((os.path.basename(r.path), r.reason) for r in J.read_rejects(spark, f"{tmp_path}/rej").collect())
    assert got == [("bad.json", "invalid_json"), ("huge.json", "too_large"), ("s1.json", "element_not_object")]


def test_stream_takes_only_new_files_and_latest_wins(spark, tmp_path):
    raw, inc, cp, cur, h = (f"{tmp_path}/{n}" for n in ("raw", "inc", "cp", "cur", "h"))
    ws = spark.createDataFrame([("w", "W", "T")], "id string, name string, type string")

    def run():
        ST.stage_increments(ST.read_payload_stream(spark, raw, files_per_trigger=1), inc, cp)
        ST.update_fingerprints(spark, inc, ws, "t", h)
        return ST.merge_increments(spark, inc, cur)

    os.makedirs(raw)
    assert run() == 0  # nothing landed yet
    land(raw, "1.json", one_item(id="a", name="first", type="report"))
    assert run() == 1
    hash1 = I.read_fingerprints(spark, h).first().connection_hash
    land(raw, "2.json", one_item(id="a", name="second", type="report"))
    land(raw, "3.json", one_item(id="b", name="other", type="dataset", datasources=[{"connectionDetails": {"server": "s"}}]))
    (tmp_path / "raw" / "bad.json").write_text("{")
    assert run() == 2
    assert names(I.read_inventory(spark, cur)) == [("w", "unknown", "other"), ("w", "unknown", "second")]
    assert I.read_fingerprints(spark, h).first().connection_hash != hash1
    assert [r.reason for r in ST.read_rejects(spark, inc).collect()] == ["invalid_json"]
    # Rows saved directly are not undone by a run that finds nothing new.
    TB.save_inventory(I.read_inventory(spark, cur).withColumn("item_name", F.lit("newest")), cur, mode="merge")
    versions = len(os.listdir(cur))
    assert run() == 2 and {n[2] for n in names(I.read_inventory(spark, cur))} == {"newest"}
    assert len(os.listdir(cur)) == versions


def test_stream_scans_replace_each_other(spark, tmp_path):
    raw, inc, cp, cur, h = (f"{tmp_path}/{n}" for n in ("raw", "inc", "cp", "cur", "h"))
    ws = spark.createDataFrame([("w", "W", "T"), ("e", "E", "T")], "id string, name string, type string")

    def scan(day, name, **items):
        land(f"{raw}/scan_date={day}", name, {"workspaces": [{"id": w, "items": [{"id": i, "name": i, "type": "report"} for i in of]} for w, of in items.items()]})

    def run():
        ST.stage_increments(ST.read_payload_stream(spark, raw, files_per_trigger=1), inc, cp)
        ST.update_fingerprints(spark, inc, ws, "t", h)
        ST.merge_increments(spark, inc, cur)
        rows = sorted((r.workspace_id, r.item_id) for r in I.read_inventory(spark, cur).collect())
        return rows, {r.workspace_id: r.connection_hash for r in I.read_fingerprints(spark, h).collect()}

    scan("1", "a.json", w=["a"], e=["x"])
    scan("1", "b.json", w=["b"])
    rows, first = run()
    assert rows == [("e", "x"), ("w", "a"), ("w", "b")]
    scan("2", "a.json", w=["a"], e=["x"])
    run()
    scan("2", "b.json", w=["b"])  # the rest of the second scan, in a run of its own
    assert run() == (rows, first)
    scan("3", "a.json", w=["b"], e=[])
    rows, last = run()
    assert rows == [("w", "b")] and last["e"] == hashlib.sha256(b"").hexdigest() and last["w"] != first["w"]


def test_partitioned_merge_rewrites_only_what_it_touches(spark, tmp_path):
    base = f"{tmp_path}/p"
    first = frame(spark, *[row(ws=f"w{i}", item_name="old") for i in range(40)])
    assert TB.merge_partitioned(first, base, parts=8) == 40
    parts = [d for d in os.listdir(base) if d.startswith("_part=")]
    assert len(parts) == 8
    before = {d: sorted(os.listdir(f"{base}/{d}")) for d in parts}
    # The table keeps its number of partitions, whatever a later call says.
    TB.merge_partitioned(frame(spark, row(ws="w3", item_name="new"), row(ws="w3", con="x")), base, parts=5)
    assert sum(sorted(os.listdir(f"{base}/{d}")) != files for d, files in before.items()) == 1
    inv = I.read_inventory(spark, base)
    assert {r.item_name for r in inv.filter("workspace_id = 'w3' AND connector = 'sql'").collect()} == {"new"}
    assert inv.filter("item_name = 'old'").count() == 39 and inv.count() == 41
    assert TB.merge_partitioned(frame(spark), base) == 0
    gone = spark.createDataFrame([(f"w{i}",) for i in range(40)], "workspace_id string")
    assert TB.merge_partitioned(frame(spark), base, scanned=gone) == 0 and I.read_inventory(spark, base).count() == 0
