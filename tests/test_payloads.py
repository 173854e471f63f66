"""Reading documents: root shapes, malformed spots, files."""

import json
import os

import pytest

from test_flatten import docs, one_item

from linkledger.operators import flatten as FL
from linkledger.sources import payloads as P

GOOD = one_item(type="report")


def rejects(spark, *roots):
    return sorted((r.path, r.position, r.reason, r.n) for r in P.payload_rejects(docs(spark, *roots)).collect())


def rows(spark, *roots):
    return FL.flatten_payloads(P.payload_roots(docs(spark, *roots))).count()


def test_object_and_list_roots(spark):
    assert rows(spark, GOOD, [GOOD, GOOD], [], {}, {"workspaces": None}, [{"workspaces": []}]) == 3
    assert rejects(spark, GOOD, [GOOD]) == []


def test_good_siblings_survive_bad_elements(spark):
    ws = {"workspaces": [GOOD["workspaces"][0], 5, {"id": "v", "items": [3, {"id": "j", "type": "report"}, None]}]}
    assert rows(spark, ws, [GOOD, 4, "x"]) == 3
    assert rejects(spark, ws, [GOOD, 4, "x"]) == [
        ("f0.json", 0, "item_not_object", 2), ("f0.json", 0, "workspace_not_object", 1),
        ("f1.json", 1, "element_not_object", 1), ("f1.json", 2, "element_not_object", 1),
    ]


def test_malformed_leaf_is_nulled_alone(spark):
    bad = one_item(type="notebook", connections=[{"type": "a"}, {"type": "b", "isCloud": None}], properties=7)
    got = FL.flatten_payloads(P.payload_roots(docs(spark, bad))).select("connector", "connection_scope").collect()
    assert sorted(map(tuple, got)) == [("a", "Cloud"), ("b", "OnPremViaGateway")]
    assert rows(spark, {"workspaces": "oops"}) == 0


def test_unusable_documents_are_rejected(spark):
    bad = ["{bad", "", "  ", "7", "null", '"x"', json.dumps(GOOD) + " trailing", json.dumps(GOOD) + "," + json.dumps(GOOD),
           json.dumps(GOOD)[:-2], "{'workspaces': []}", json.dumps([GOOD]) + " 7"]
    assert rows(spark, *bad) == 0
    assert {(r[0], r[2]) for r in rejects(spark, *bad)} == {
        (f"f{i}.json", "root_not_object" if i in (3, 4, 5) else "invalid_json") for i in range(len(bad))
    }


def test_large_documents_lose_only_what_is_bad(spark):
    big = one_item(type="report", name="x" * 20_000_000)
    assert rows(spark, big) == 1
    assert rejects(spark, big) == []
    assert [r[2] for r in rejects(spark, json.dumps(big)[:-3])] == ["invalid_json"]
    many = {"workspaces": [{"id": "w", "items": [7] + [{"id": str(i), "name": "y" * 2000, "type": "report"} for i in range(10_000)]}]}
    assert rows(spark, many) == 10_000
    assert rejects(spark, many) == [("f0.json", 0, "item_not_object", 1)]


def test_files_suffix_size_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(GOOD, indent=1))
    (tmp_path / "b.json").write_text(json.dumps([GOOD, one_item(type="report", name="y" * 4000)]))
    (tmp_path / "c.txt").write_text(json.dumps(GOOD))
    path = str(tmp_path)
    read = P.read_payload_text(spark, path)
    assert FL.flatten_payloads(P.payload_roots(read)).count() == 3
    assert P.read_payload_text(spark, path, skip_larger_than=1000).count() == 1
    skipped = P.oversized_files(spark, path, max_bytes=1000).collect()
    assert [(os.path.basename(r.path), r.reason) for r in skipped] == [("b.json", "too_large")]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "d.json").write_text("\n".join(json.dumps(GOOD) for _ in range(4)))
    assert FL.flatten_payloads(P.payload_roots(P.read_payload_text(spark, path + "/lines", per_line=True))).count() == 4


def test_oversized_file_is_never_lost_silently(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(GOOD))
    with open(tmp_path / "huge.json", "wb") as f:
        f.truncate(2 * 1024**3 + 1)  # sparse, takes no disk
    with pytest.raises(Exception):
        FL.flatten_payloads(P.payload_roots(P.read_payload_text(spark, str(tmp_path)))).count()
    read = P.read_payload_text(spark, str(tmp_path), skip_larger_than=2 * 1024**3)
    assert FL.flatten_payloads(P.payload_roots(read)).count() == 1
    assert P.oversized_files(spark, str(tmp_path), 2 * 1024**3).count() == 1


def test_workspace_list_shapes(spark):
    got = P.workspace_list(docs(spark, [{"id": "a"}, 3], {"workspaces": [{"id": "b", "type": "T"}, None]}, {}, [])).collect()
    assert sorted((r.id, r.type) for r in got) == [("a", None), ("b", "T")]


def test_legacy_layout_is_counted_but_not_flattened(spark):
    old = {"workspaces": [{"id": "w", "datasets": [{"datasources": [
        {"datasourceType": "Sql", "connectionDetails": {"server": "s"}}, {"datasourceType": "File"}]}]}]}
    assert rows(spark, old) == 0
    assert P.legacy_datasource_count(docs(spark, old)).first().datasources == 1


def test_parsed_once(spark):
    plan = FL.flatten_payloads(P.payload_roots(docs(spark, GOOD)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructField(roots,ArrayType(StructType") == 1  # the strict pass; the tolerant one is for malformed text only


def test_scan_documents(spark):
    df = spark.createDataFrame([("x/s1.json", "{}"), ("x/s10.json", "{}")], "path string, text string")
    assert [r.path for r in P.documents_of_scan(df, "s1").collect()] == ["x/s1.json"]
