"""Working folders and versions are dense, rows that are landed aren't landed again, digests don't travel."""

import glob
import json
import os
import time

import pyarrow.parquet as pq

from linkledger.operators import flatten as FL
from linkledger.operators import merge as M
from linkledger.operators import sidecar as SC
from linkledger.plans import jobs as J
from linkledger.schemas import CONNECTION_SCHEMA
from linkledger.sinks import tables as TB
from linkledger.sinks import versions as V
from linkledger.sources import payloads as P
from linkledger.sources.inventory import read_inventory
from linkledger.streaming import ingest as ST


def rows_of(spark, *keys):
    df = spark.createDataFrame(list(keys), "workspace_id string, item_id string")
    given = set(df.columns)
    return df.selectExpr(*[f.name if f.name in given else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in CONNECTION_SCHEMA])


def codecs(folder):
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)
            if pq.ParquetFile(f).metadata.num_row_groups}


def test_versions_are_dense(spark, tmp_path):
    TB.save_inventory(rows_of(spark, ("a", "1")), f"{tmp_path}/inv")
    TB.merge_partitioned(rows_of(spark, ("a", "1")), f"{tmp_path}/parts", parts=2)
    V.save_version(rows_of(spark, ("a", "1")), f"{tmp_path}/versions", buckets=2)
    assert [codecs(f"{tmp_path}/{d}") for d in ("inv", "parts", "versions")] == [{"ZSTD"}] * 3


def test_a_job_lands_its_rows_once(spark, tmp_path, monkeypatch):
    os.makedirs(f"{tmp_path}/raw/scan_date=2024-01-30")
    with open(f"{tmp_path}/raw/scan_date=2024-01-30/a.json", "w") as f:
        f.write('{"workspaces":[{"id":"w","items":[{"id":"i","type":"Report"}]}]}')
    again = []
    monkeypatch.setattr(TB, "staged", lambda rows: again.append(rows))
    for name, partitions in (("plain", None), ("parts", 2)):
        J.scan_directory(spark, f"{tmp_path}/raw", f"{tmp_path}/{name}", partitions=partitions)
        assert [r.workspace_id for r in read_inventory(spark, f"{tmp_path}/{name}").collect()] == ["w"]
    assert not again


def test_version_rows_travel_without_their_digest(spark, tmp_path):
    """With null keys and copies; the dealt rows need no other shuffle to meet a stored version."""
    old = rows_of(spark, ("a", "1"), ("a", "1"), (None, "1"), ("b", None))
    base = f"{tmp_path}/versions"
    V.save_version(old, base, buckets=2)
    dealt = V._in_buckets(M.dedup(old), 2)
    shuffles = [s for s in dealt._jdf.queryExecution().optimizedPlan().toString().split("\n") if "RepartitionByExpression" in s]
    assert len(shuffles) == 1 and "sha2" in shuffles[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = V.read_version(spark, base).select(V.ID).join(dealt.select(V.ID), V.ID, "full_outer")
        assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # dedup, dealing
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    V.merge_version(rows_of(spark, ("a", "1"), (None, "1"), ("c", "9")), base)
    found = sorted(((r.workspace_id, r.item_id) for r in V.read_version(spark, base).collect()), key=repr)
    assert found == sorted([("a", "1"), (None, "1"), ("b", None), ("c", "9")], key=repr)


def test_documents_are_landed_by_item(spark, tmp_path, monkeypatch):
    """No landed row has more than an item, however large its document: readers of columns take thousands of rows at once."""
    os.makedirs(f"{tmp_path}/raw/scan_date=2024-01-30")
    items = [{"id": f"i{k}", "type": "Report"} for k in range(50)]
    with open(f"{tmp_path}/raw/scan_date=2024-01-30/a.json", "w") as f:
        json.dump({"workspaces": [{"id": "w", "items": items}, {"id": "empty"}]}, f)
    monkeypatch.setattr(J.S, "delete", lambda *_: None)
    folders, plain = [], J.scratch_dir
    for module in (J, ST):
        monkeypatch.setattr(module, "scratch_dir", lambda *a: folders.append(plain(*a)) or folders[-1])
    J.scan_directory(spark, f"{tmp_path}/raw", f"{tmp_path}/inv")
    ST.stage_increments(ST.read_payload_stream(spark, f"{tmp_path}/raw"), f"{tmp_path}/inc", f"{tmp_path}/cp")
    for path in (f"{folders[0]}/parsed", folders[1]):
        sizes = "aggregate(payload.workspaces, 0, (n, w) -> n + greatest(size(w.items), 0))"
        assert sorted(r[0] for r in spark.read.parquet(path).selectExpr(f"{sizes} AS n").collect()) == [0] + [1] * 50
    assert read_inventory(spark, f"{tmp_path}/inv").count() == 50


def test_pieces_give_what_whole_documents_give(spark):
    """Rejects, connections, workspaces, sidecars and one head a document, with nulls and things of the wrong kind."""
    item = {"id": "b", "type": "Dataset", "datasources": [{"connectionDetails": {"server": "s"}}, {"gatewayId": "g"}]}
    users = [{"emailAddress": "a@b", "workspaceUserAccessRight": "Admin"}]
    one = {"workspaces": [{"id": "w1", "name": "n", "users": users, "items": [{"id": "a", "type": "Report"}, item, 3]}, {"id": "w2"}, {"id": "w3", "items": []},
                          {"id": None, "items": [item]}, 5], "workspace_sidecar": {"w1": {"name": "N", "users": "x"}, "w2": {"kind": None}}}
    texts = [json.dumps(one), json.dumps([one, 7, {"workspaces": None}, one]), "{bad", "[]", "7", "", None, "{} {}", '{"workspaces":[]}', json.dumps([one])[:-9]]
    texts += [json.dumps({"workspaces": [{"id": "w", "items": [{"id": "b", "type": "Dataset", "datasources": [{"connectionDetails": "oops"}, {"gatewayId": {"x": 1}}]}]}]})]
    docs = spark.createDataFrame([(f"p{i}", "s", t) for i, t in enumerate(texts)], "path string, scan string, text string")
    parsed = P.parse_documents(docs)
    pieces = P.pieces_of(parsed)
    plans = [d._jdf.queryExecution().optimizedPlan().toString().count("from_json") for d in (parsed, pieces)]
    assert plans[0] == plans[1]  # nothing is parsed again
    keys = ("path", "scan", "position")
    for of in (
        P.rejects_of, lambda d: FL.flatten_payloads(P.roots_of(d), carry=keys), lambda d: FL.explode_workspaces(P.roots_of(d), keys).drop("items").distinct(),
        lambda d: SC.build_sidecar(SC.payload_workspaces(P.roots_of(d)), "by_id"), lambda d: SC.build_sidecar(SC.payload_workspaces(P.roots_of(d))), P.repeats,
        lambda d: (d.filter("head") if "head" in d.columns else d).select("path", "scan", "digest"),
    ):
        old, new = (sorted(map(repr, of(d).collect())) for d in (parsed, pieces))
        assert old == new


def test_versions_leave_no_shuffle_files(spark, tmp_path):
    """Each version's shuffle files go once it is written; the session's setting stays what it was."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    before, base = files(), f"{tmp_path}/versions"
    V.save_version(rows_of(spark, ("a", "1"), ("a", "1"), ("b", "2")), base, buckets=2)
    V.merge_version(rows_of(spark, ("a", "1"), ("c", "9")), base)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and setting not in spark.conf.getAll
    spark.conf.set(setting, "false")
    try:
        V.merge_version(rows_of(spark, ("d", "1")), base)
        assert spark.conf.getAll[setting] == "false"
    finally:
        spark.conf.unset(setting)
    assert V.read_version(spark, base).count() == 4
