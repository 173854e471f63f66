"""Rows are moved once, by workspace, and landed texts are compressed, in files of bounded size."""

import os

from linkledger.operators import history as H
from linkledger.operators import merge as M
from linkledger.plans import reports as R
from linkledger.schemas import CONNECTION_SCHEMA
from linkledger.sinks import tables as TB
from linkledger.sources import payloads as P


def rows_of(spark, *keys):
    """Connections of (workspace, item) with their position as the item's name."""
    df = spark.createDataFrame([(*k, f"n{i}") for i, k in enumerate(keys)], "workspace_id string, item_id string, item_name string")
    given = set(df.columns)
    return df.selectExpr(*[f.name if f.name in given else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in CONNECTION_SCHEMA])


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_merging_rows_dealt_by_workspace_needs_no_other_shuffle(spark):
    old, new = rows_of(spark, ("a", "1"), ("b", "1")), rows_of(spark, ("b", "1"), ("c", "1"))
    merged = M.merge(M.dealt(old), M.dealt(new))
    assert exchanges(merged) == 2
    assert sorted(r.workspace_id for r in merged.collect()) == ["a", "b", "c"]


def test_history_moves_rows_once(spark):
    rows = rows_of(spark, ("a", "1"), ("a", "2"), (None, "3")).selectExpr("*", "'1' AS scan")
    seen = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), ("b", "1")], "workspace_id string, scan string")
    found = H.history(rows, seen)
    assert exchanges(found) == 2  # the rows, the scans
    assert sorted((r.item_id, r.valid_from, r.valid_to) for r in found.collect()) == [("1", "1", "2"), ("2", "1", "2")]


def test_large_workspaces_are_apart(spark, monkeypatch):
    """With copies, null and empty workspaces, above and below the limit."""
    keys = [("a", str(i % 3)) for i in range(9)] + [(None, str(i % 2)) for i in range(7)] + [("", "1"), ("", "1"), ("c", "1")]
    rows = rows_of(spark, *keys)
    want = sorted(map(tuple, M.dedup(rows).collect()), key=repr)
    for limit in (5, 100):
        monkeypatch.setattr(M, "HOT", limit)
        assert sorted(map(tuple, M.by_workspace(M.dedup, rows).collect()), key=repr) == want
        assert len(R.distinct_connections(rows).collect()) == len(keys)


def test_csv_files_are_bounded_and_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TB, "CSV_PER_FILE", 10)
    rows = spark.range(0, 35, 1, 1).selectExpr("id", "concat('a', chr(10), id) AS x")
    TB.save_csv(rows, f"{tmp_path}/csv")
    assert sum(f.endswith(".csv.gz") for f in os.listdir(f"{tmp_path}/csv")) == 4
    assert sorted(map(tuple, TB.read_csv(spark, f"{tmp_path}/csv", rows.schema).collect())) == sorted(map(tuple, rows.collect()))


def test_payloads_land_compressed(spark, tmp_path):
    docs = spark.createDataFrame([("p", '{"workspaces":[{"id":"w","items":[{"id":"i","type":"Report"}]}]}')], "path string, text string")
    payloads = P.payload_roots(docs).selectExpr("'full' AS scan_kind", "'2024-01-30' AS scan_date", "payload")
    TB.land_payloads(payloads, f"{tmp_path}/raw", "gzip")
    read = P.payload_roots(P.read_payload_text(spark, f"{tmp_path}/raw", "*.json.gz", per_line=True))
    assert [r.id for r in read.selectExpr("inline(payload.workspaces)").collect()] == ["w"]


def test_saving_leaves_no_working_folder(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    for mode in ("overwrite", "merge"):
        TB.save_inventory(rows_of(spark, ("a", "1"), ("a", "1")), f"{tmp_path}/inv", mode=mode)
    TB.merge_partitioned(rows_of(spark, ("a", "1")), f"{tmp_path}/parts", parts=2)
    after = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    assert not {f for f in after - before if "staged" in f or "partitions" in f}
