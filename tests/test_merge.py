"""De-duplication, merging and comparing."""

import pytest

from linkledger.operators import merge as M
from linkledger.schemas import CONNECTION_SCHEMA


def frame(spark, *rows):
    full = [tuple({"cloud": True, **r}.get(c) for c in CONNECTION_SCHEMA.names) for r in rows]
    return spark.createDataFrame(full, CONNECTION_SCHEMA)


def row(ws="w", item="i", con="sql", server=None, **other):
    return {"workspace_id": ws, "item_id": item, "connector": con, "server": server, **other}


def names(df):
    return sorted((r.workspace_id, r.connector, r.item_name) for r in df.collect())


def test_nulls_in_the_key_are_equal_and_connector_is_normalised(spark):
    df = frame(spark, row(con="SQL", item_name="b"), row(con="sql", item_name="a"), row(con=None), row(con="Unknown"))
    assert names(M.dedup(df)) == [("w", "sql", "a"), ("w", "unknown", None)]
    assert M.dedup(df).dtypes == df.dtypes


@pytest.mark.parametrize("keep, expected", [("incoming", "new"), ("existing", "old")])
def test_merge_policy(spark, keep, expected):
    old = frame(spark, row(item_name="old"), row(ws="gone", item_name="o"))
    new = frame(spark, row(item_name="new"), row(ws="added", item_name="n"))
    merged = M.merge(old, new, keep)
    assert names(merged) == sorted([("added", "sql", "n"), ("gone", "sql", "o"), ("w", "sql", expected)])
    assert names(M.merge(merged, new, keep)) == names(merged)  # idempotent


def test_merge_by_name_with_missing_columns(spark):
    old = frame(spark, row(item_name="x")).drop("generation").select("item_name", "workspace_id", "item_id", "connector",
                                                                     "server", "database", "endpoint", "cloud")
    got = M.merge(old, frame(spark, row(ws="v", generation="2")))
    assert sorted((r.workspace_id, r.generation) for r in got.collect()) == [("v", "2"), ("w", None)]


def test_merge_rejects_unknown_policy(spark):
    with pytest.raises(ValueError):
        M.merge(frame(spark), frame(spark), "both")


def test_replace_scanned_removes_what_vanished(spark):
    old = frame(spark, row(item="a"), row(item="b"), row(ws="v"))
    new = frame(spark, row(item="a", item_name="n"))
    scanned = spark.createDataFrame([("w",), ("u",)], "workspace_id string")
    got = M.replace_scanned(old, new, scanned)
    assert sorted((r.workspace_id, r.item_id) for r in got.collect()) == [("v", "i"), ("w", "a")]


def test_snapshot_diff_is_null_safe(spark):
    before = frame(spark, row(), row(ws="gone", server=None))
    after = frame(spark, row(con="SQL"), row(ws="added"), row(ws="added"))
    got = {(r.workspace_id, r.change) for r in M.snapshot_diff(before, after).collect()}
    assert got == {("gone", "removed"), ("added", "added")}


def test_chunks_and_latest(spark):
    parts = [frame(spark, row(item_name=n)) for n in ("one", "two", "three")]
    assert names(M.merge_all(parts)) == [("w", "sql", "three")]
    assert names(M.merge_all(parts, keep="first")) == [("w", "sql", "one")]


def test_duplicates(spark):
    got = M.duplicates(frame(spark, row(), row(), row(ws="v"))).collect()
    assert [(r.workspace_id, r["count"]) for r in got] == [("w", 2)]


def test_hot_key_is_combined_before_the_shuffle(spark):
    """Two thirds of all rows are copies of one key; each task sends one of them on."""
    hot = spark.range(0, 200_000, 1, 8).selectExpr("'w' AS workspace_id", "'i' AS item_id", "'sql' AS connector")
    cold = spark.range(0, 100_000, 1, 8).selectExpr("concat('w', id) AS workspace_id", "'i' AS item_id", "'sql' AS connector")
    rows = hot.unionByName(cold)
    for c in CONNECTION_SCHEMA.names:
        if c not in rows.columns:
            rows = rows.selectExpr("*", f"CAST(NULL AS {CONNECTION_SCHEMA[c].dataType.simpleString()}) AS {c}")
    out = M.dedup(rows)
    assert out.count() == 100_001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
