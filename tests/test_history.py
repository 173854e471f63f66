"""Connection history, stored versions and the digest tree."""

import os
import random

import pytest
from test_merge import frame, row

from linkledger.operators import digest_tree as DT
from linkledger.operators import fingerprint as FP
from linkledger.operators import history as H
from linkledger.schemas import CONNECTION_COLUMNS, CONNECTION_SCHEMA
from linkledger.sinks import history as HS
from linkledger.sinks import snapshots as S
from linkledger.sinks import versions as V
from pyspark.sql import functions as F


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "workspace_id string")


def short(df):
    return sorted((r.workspace_id, r.connector, r.item_name, r.valid_from, r.valid_to or "") for r in df.collect())


#: Scan, what it found (workspace, connector, item name), the workspaces it looked at.
STORY = [
    ("1", [("w", "a", "x"), ("w", "b", "x"), ("v", "a", "x")], ["w", "v", "e"]),
    ("2", [("w", "a", "x")], ["w"]),                          # b goes; v isn't looked at
    ("3", [("w", "a", "y"), ("w", "b", "x"), ("v", "a", "x")], ["w", "v"]),  # a changes, b comes back
    ("4", [("w", "a", "y"), ("w", "a", "y")], ["w", "v"]),    # b goes again, v is empty now
]
WANT = [
    ("v", "a", "x", "1", "4"), ("w", "a", "x", "1", "3"), ("w", "a", "y", "3", ""), ("w", "b", "x", "1", "2"), ("w", "b", "x", "3", "4"),
]


def scans(spark, story=STORY):
    return [(s, frame(spark, *[row(ws=w, con=c, item_name=n) for w, c, n in found]), ids(spark, *looked)) for s, found, looked in story]


def all_at_once(spark, story):
    rows = seen = None
    for s, found, looked in scans(spark, story):
        found, looked = found.withColumn("scan", F.lit(s)), looked.withColumn("scan", F.lit(s))
        rows, seen = (found, looked) if rows is None else (rows.unionByName(found), seen.unionByName(looked))
    return H.history(rows, seen)


def test_history_of_many_scans(spark):
    assert short(all_at_once(spark, STORY)) == WANT
    assert sorted((r.workspace_id, r.connector, r.first_seen) for r in H.appeared(all_at_once(spark, STORY), "0", "2").collect()) == [
        ("v", "a", "1"), ("w", "a", "1"), ("w", "b", "1")]
    assert H.appeared(all_at_once(spark, STORY), "1", "9").count() == 0


def test_history_scan_by_scan(spark, tmp_path):
    base = f"{tmp_path}/h"
    for s, rows, looked in scans(spark):
        HS.record_scan(rows, looked, s, base)
        HS.record_scan(rows, looked, s, base)  # once more changes nothing
    assert short(HS.read_history(spark, base)) == WANT
    for at, want in {"0": [], "1": [("v", "a"), ("w", "a"), ("w", "b")], "2": [("v", "a"), ("w", "a")], "3": [("v", "a"), ("w", "a"), ("w", "b")], "9": [("w", "a")]}.items():
        got = HS.read_as_of(spark, base, at)
        assert got.columns == CONNECTION_COLUMNS and sorted((r.workspace_id, r.connector) for r in got.collect()) == want
    with pytest.raises(ValueError, match="before the last"):
        HS.record_scan(*scans(spark)[0][1:], "3", base)


def test_a_lost_run_is_made_up_for(spark, tmp_path):
    base = f"{tmp_path}/h"
    (_, r1, l1), (_, r2, l2), *_ = scans(spark)
    HS.record_scan(r1, l1, "1", base)
    HS.record_scan(r2, l2, "2", base)
    os.rename(f"{base}/open/v00000002/_SUCCESS", f"{base}/open/v00000002/lost")  # the ended intervals are written, the open ones aren't
    assert short(HS.read_history(spark, base)) == [("v", "a", "x", "1", ""), ("w", "a", "x", "1", ""), ("w", "b", "x", "1", "")]
    HS.record_scan(r2, l2, "2", base)
    assert short(HS.read_history(spark, base)) == [("v", "a", "x", "1", ""), ("w", "a", "x", "1", ""), ("w", "b", "x", "1", "2")]


def test_both_ways_give_the_same(spark, tmp_path):
    rng, base = random.Random(8), f"{tmp_path}/h"
    story = []
    for s in range(6):
        looked = [w for w in "abcd" if rng.random() < 0.7]
        story.append((f"2024-01-0{s + 1}T12:00:00Z", [(w, c, rng.choice("xy")) for w in looked for c in "pqr" if rng.random() < 0.6], looked or ["a"]))
    for s, rows, looked in scans(spark, story):
        HS.record_scan(rows, looked, s, base)
    assert short(HS.read_history(spark, base)) == short(all_at_once(spark, story))
    for s, _, _ in story:  # as of a scan: of each workspace what its last scan until then found
        last = {w: found for t, found, looked in story if t <= s for w in looked}
        want = {(w, c, n) for w, found in last.items() for v, c, n in found if v == w}
        assert {(r.workspace_id, r.connector, r.item_name) for r in HS.read_as_of(spark, base, s).collect()} == want


def test_as_of_prunes_what_ended_before(spark, tmp_path):
    base = f"{tmp_path}/h"
    for s, rows, looked in scans(spark):
        HS.record_scan(rows, looked, s, base)
    plan = HS.read_as_of(spark, base, "3")._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in plan.split("\n") if "PartitionFilters: [" in line]
    assert any("valid_to" in f and "> 3)" in f and "<= 4)" in f for f in filters), filters


def test_versions_are_addressed_and_compared_without_exchange(spark, tmp_path):
    base = f"{tmp_path}/v"
    none = row(ws="n", con="sql")
    assert V.save_version(frame(spark, row(ws="a", item_name="1"), row(ws="b"), none, none), base, buckets=4) == 1
    assert V.merge_version(frame(spark, row(ws="a", item_name="2"), row(ws="c")), base) == 2
    assert V.merge_version(frame(spark, row(ws="d")), base, scanned=ids(spark, "a", "d")) == 3
    assert V.versions(spark, base) == [1, 2, 3]

    def at(v):
        return sorted((r.workspace_id, r.item_name) for r in V.read_version(spark, base, v).collect())

    assert [w for w, _ in at(1)] == ["a", "b", "n"] and ("a", "2") in at(2) and [w for w, _ in at(None)] == ["b", "c", "d", "n"]
    got = V.diff_versions(spark, base, 1, 3)
    assert sorted((r.workspace_id, r.change) for r in got.collect()) == [("a", "removed"), ("c", "added"), ("d", "added")]
    assert [(r.workspace_id, r.change) for r in V.diff_versions(spark, base, 1, 2).orderBy("workspace_id").collect()] == [("a", "changed"), ("c", "added")]
    assert V.diff_versions(spark, base, 2, 2).count() == 0
    plan = V.diff_versions(spark, base, 1, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    with pytest.raises(ValueError, match="no version 7"):
        V.read_version(spark, base, 7)
    # Another session's catalog doesn't know the tables; they are found by their folders.
    for v in (1, 2, 3):
        spark.sql(f"DROP TABLE {V._table(base, v)}")
    assert V.diff_versions(spark, base, 1, 3).count() == 3
    assert "Exchange" not in V.diff_versions(spark, base, 1, 3)._jdf.queryExecution().executedPlan().toString()


def test_a_version_that_was_not_finished_does_not_count(spark, tmp_path):
    base = f"{tmp_path}/v"
    V.save_version(frame(spark, row()), base, buckets=2)
    os.makedirs(f"{base}/v00000002")
    assert V.versions(spark, base) == [1] and V.merge_version(frame(spark, row(ws="z")), base) == 3


def test_digest_tree(spark, tmp_path):
    old = frame(spark, *[row(ws=f"w{i}", item=f"i{j}", con="sql") for i in range(20) for j in range(3)], row(ws="gone"), row(ws=None))
    new = frame(spark, *[row(ws=f"w{i}", item=f"i{j}", con="new" if (i, j) == (3, 1) else "sql") for i in range(20) for j in range(3) if (i, j) != (4, 2)],
                row(ws="w5", item="more"), row(ws="w6", item="i0", con="sql"))
    DT.save_tree(old, f"{tmp_path}/old", parts=8)
    DT.save_tree(new, f"{tmp_path}/new", parts=8)
    got = DT.drilldown(spark, f"{tmp_path}/old", f"{tmp_path}/new")
    assert sorted((r.workspace_id, r.item_id, r.change) for r in got.collect()) == [
        ("gone", "i", "removed"), ("w3", "i1", "changed"), ("w4", "i2", "removed"), ("w5", "more", "added"), ("w6", "i0", "changed")]
    hashes = {r.workspace_id: r.connection_hash for r in spark.read.parquet(f"{tmp_path}/old/workspaces").collect()}
    assert hashes == {r.workspace_id: r.connection_hash for r in FP.connection_hashes(old).collect()}


def test_unchanged_workspaces_items_are_not_read(spark, tmp_path):
    old = frame(spark, *[row(ws=f"w{i}", item="i") for i in range(60)])
    new = frame(spark, *[row(ws=f"w{i}", item="i", con="x" if i == 7 else "sql") for i in range(60)])
    for name, rows in (("old", old), ("new", new)):
        DT.save_tree(rows, f"{tmp_path}/{name}", parts=16)
    read = DT.drilldown(spark, f"{tmp_path}/old", f"{tmp_path}/new")
    parts = {f.split("_part=")[1].split("/")[0] for f in read.inputFiles() if "/items/" in f}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 1 and len(parts) == 16 and "PartitionFilters: [(_part#" in plan.replace("isnotnull", "")


def test_write_note_before_version(spark, tmp_path):
    S.write_note(spark, f"{tmp_path}/t", 1, {"x": 1})
    assert S.read_note(spark, f"{tmp_path}/t") == {} and S.current_path(spark, f"{tmp_path}/t") is None
    assert S.read_snapshot(spark, f"{tmp_path}/t", CONNECTION_SCHEMA).count() == 0
