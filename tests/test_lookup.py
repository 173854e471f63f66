"""Stores for searches and look-ups, and payload drift."""

import json
import os
import random

import pytest
from test_flatten import docs
from test_merge import frame, row

from linkledger.operators import drift as DR
from linkledger.schemas import CONNECTION_COLUMNS
from linkledger.sinks import lookup as L
from linkledger.sinks import text_index as TI
from linkledger.sinks import tables as TB
from linkledger.sources import inventory as I
from linkledger.streaming import ingest as ST
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def owners(spark, tmp_path_factory):
    rng, base = random.Random(6), f"{tmp_path_factory.mktemp('index')}/i"
    texts = [", ".join(f"user{rng.randint(1, 400)}@ex{rng.randint(1, 3)}.org" for _ in range(rng.randint(1, 4))) for _ in range(60)]
    texts += ["ab", "", "Größe@x", "user1@ex1.org", None]
    rows = frame(spark, *[row(ws=f"w{i}", workspace_users=rng.choice(texts), item_name=str(i)) for i in range(300)], row(ws="z", workspace_users="ab"))
    TI.save_index(rows, "workspace_users", base, parts=8)
    return rows.cache(), base


@pytest.mark.parametrize("needle", ["user1@ex1.org", "user1", "ser2", "@ex3.org, user", "öß", "ab", "b", "", "nobody", "USER1", "%", "ttt"])
def test_search_is_like(spark, owners, needle):
    rows, base = owners
    got = TI.search(spark, base, needle)
    assert set(CONNECTION_COLUMNS) <= set(got.columns)
    want = rows.filter(F.col("workspace_users").contains(needle))
    assert sorted(r.item_name or "" for r in got.collect()) == sorted(r.item_name or "" for r in want.collect())


def scans(df):
    """Root path, partition filters and data filters of each scan of a plan."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return [
        (f.relation().location().rootPaths().mkString(","), f.partitionFilters().mkString(","), f.dataFilters().mkString(","))
        for f in found if f.nodeName().startswith("Scan parquet")
    ]


def test_search_reads_its_lists_and_the_matching_rows(spark, owners):
    rows, base = owners
    assert spark.read.parquet(f"{base}/rows").count() == rows.count()  # rows without a text are kept
    found = {root.rsplit("/", 1)[1]: rest for root, *rest in scans(TI.search(spark, base, "user1@ex1.org"))}
    assert set(found) == {"postings", "texts", "rows"}
    assert "_part" in found["postings"][0] and "gram" in found["postings"][1]
    assert "_part" in found["rows"][0] and "Contains(text" in found["texts"][1]


def _rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_short_list_skips_row_groups(spark, tmp_path):
    n = 40_000
    rows = spark.range(n).selectExpr("concat('w', lpad(id div 4, 6, '0')) AS workspace_id", *[
        f"concat('{c}', id) AS {c}" if c not in ("cloud", "is_dedicated_capacity") else f"true AS {c}" for c in CONNECTION_COLUMNS if c != "workspace_id"])
    L.save_lookup(rows.select(*CONNECTION_COLUMNS), f"{tmp_path}/l", row_group=200_000)
    few = spark.createDataFrame([("w000007",), ("w009000",), (None,), ("none",)], "workspace_id string")
    got = L.lookup(spark, f"{tmp_path}/l", few)
    assert got.count() == 8 and _rows_scanned(L.lookup(spark, f"{tmp_path}/l", few)) < n // 4
    absent = spark.createDataFrame([("w000007x",)], "workspace_id string")  # inside a range, but no Bloom filter has it
    assert _rows_scanned(L.lookup(spark, f"{tmp_path}/l", absent)) == 0
    many = spark.range(300).selectExpr("concat('w', lpad(id, 6, '0')) AS workspace_id")
    assert L.lookup(spark, f"{tmp_path}/l", many).count() == 1200
    assert L.lookup(spark, f"{tmp_path}/l", few.limit(0)).count() == 0


def test_drift(spark):
    items = [
        {"id": "a", "type": "Report", "name": 1, "extra": {"x": [1, 2], "y": {"z": None}}},
        {"id": "b", "type": "report", "extra": "now text"},
        {"id": "c", "type": "Dataset", "datasources": [{"connectionDetails": {"server": "s", "port": 1433}, "gatewayId": {"any": 1}}], "properties": "flat"},
        {"id": "d", "type": None, "datasources": {"not": "a list"}}, 5, None,
    ]
    got = DR.drift(docs(spark, {"workspaces": [{"id": "w", "items": items}, {"id": "v"}]}, [{"workspaces": [{"items": [{"new": True}]}]}, 7], "{"))
    assert [tuple(r) for r in got.collect()] == [
        ("dataset", "datasources[].connectionDetails.port", "bigint", None),
        ("dataset", "properties", "string", "struct<generation:string>"),
        ("report", "extra", "variant", None),
        ("unknown", "datasources", "struct<not:string>", got.filter("kind = 'unknown' AND path = 'datasources'").first().expected),
        ("unknown", "new", "boolean", None),
    ]
    assert DR.drift(docs(spark, {"workspaces": [{"id": "w", "items": [{"id": "a", "type": "x", "name": "n"}]}]})).count() == 0


def test_stream_into_partitions_touches_what_it_saw(spark, tmp_path):
    raw, inc, cp, cur = (f"{tmp_path}/{n}" for n in ("raw", "inc", "cp", "cur"))

    def run(scan, **items):
        os.makedirs(f"{raw}/scan_date={scan}", exist_ok=True)
        with open(f"{raw}/scan_date={scan}/a.json", "w") as f:
            json.dump({"workspaces": [{"id": w, "items": [{"id": i, "name": i, "type": "report"} for i in of]} for w, of in items.items()]}, f)
        ST.stage_increments(ST.read_payload_stream(spark, raw), inc, cp)
        return ST.merge_increments(spark, inc, cur, partitions=16)

    assert run("1", **{f"w{i}": ["a", "b"] for i in range(40)}) == 80
    parts = [d for d in os.listdir(cur) if d.startswith("_part=")]
    before = {d: sorted(os.listdir(f"{cur}/{d}")) for d in parts}
    run("2", w3=["a"], w4=[])
    assert 1 <= sum(sorted(os.listdir(f"{cur}/{d}")) != files for d, files in before.items()) <= 2
    inv = I.read_inventory(spark, cur)
    assert inv.count() == 77 and inv.filter("workspace_id IN ('w3', 'w4')").count() == 1
    assert ST.merge_increments(spark, inc, cur, partitions=16) == 0  # nothing new
    # Of the staged rows only the new scans' folders are read.
    _, rows, _ = ST._latest(spark, inc, 0)
    staged = [filters for root, filters, _ in scans(rows) if root.endswith("/rows")]
    assert len(staged) == 1 and "scan-2" in staged[0] and "scan-1" not in staged[0]


def test_partitioned_inventory_reads_only_touched_partitions(spark, tmp_path):
    base = f"{tmp_path}/p"
    TB.merge_partitioned(frame(spark, *[row(ws=f"w{i}") for i in range(40)]), base, parts=8)
    read = TB._partitions(spark, base).filter(F.col(TB.PART).isin(["3-of-8"]))
    ((_, filters, _),) = scans(read)
    assert "3-of-8" in filters
