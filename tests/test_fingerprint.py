"""Fingerprints against an independent computation, diffs, upserts, recency."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from linkledger.operators import fingerprint as FP

FIELDS = ["connector", "server", "database", "endpoint"]


def expected(conns):
    key = lambda c: f"{c['connector']}_{c['server']}_{c['database']}"
    docs = sorted(((key(c), json.dumps(c, sort_keys=True)) for c in conns))
    return hashlib.sha256(("[" + ", ".join(d for _, d in docs) + "]").encode()).hexdigest()


def frame(spark, by_ws):
    rows = [(ws, "i", *[c[f] for f in FIELDS]) for ws, conns in by_ws.items() for c in conns]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "workspace_id string, item_id string, " + ", ".join(f"{f} string" for f in FIELDS))


def conn(*values):
    return dict(zip(FIELDS, values))


def hashes(df):
    return {r.workspace_id: r.connection_hash for r in df.collect()}


BY_WS = {
    "plain": [conn("sql", "s", "d", None), conn("adls", None, None, "e"), conn("sql", "s", "d", None)],
    "quotes": [conn('a"b', "c\\d", "\n\t\r\b\f", "/")],
    "unicode": [conn("größe", "日本", "😀 x", "\u007f\u0001")],
    "ties": [conn("web", None, None, "b"), conn("web", None, None, "a")],
    "null": [conn(None, None, None, None)],
    "empty": [conn("", "", "", "")],
}


def summed(conns):
    digests = [hashlib.sha256(json.dumps(c, sort_keys=True, ensure_ascii=True).encode()).hexdigest() for c in conns]
    lanes = [sum(int(d[8 * i : 8 * i + 8], 16) for d in digests) for i in range(8)]
    return hashlib.sha256(":".join(map(str, [len(conns), *lanes])).encode()).hexdigest()


def test_sums_of_digests(spark):
    assert hashes(FP.connection_hashes(frame(spark, BY_WS))) == {ws: summed(c) for ws, c in BY_WS.items()}


def test_same_bytes_as_sorted_json(spark):
    assert hashes(FP.connection_hashes(frame(spark, BY_WS), as_list=True)) == {ws: expected(c) for ws, c in BY_WS.items()}


def test_item_id_is_optional(spark):
    a = spark.createDataFrame([("w", "i1", "sql", None, None, None)], "workspace_id string, item_id string, " + ", ".join(f"{f} string" for f in FIELDS))
    b = a.withColumn("item_id", F.lit("i2"))
    assert hashes(FP.connection_hashes(a)) == hashes(FP.connection_hashes(b))
    assert hashes(FP.connection_hashes(a, include_item_id=True)) != hashes(FP.connection_hashes(b, include_item_id=True))


def test_hash_depends_on_the_rows_only(spark):
    many = {"wide": [conn("sql", f"s{i % 40}", str(i), None) for i in range(500)], "small": [conn("x", None, None, None)]}
    df = frame(spark, many)
    first = hashes(FP.connection_hashes(df))
    assert first == hashes(FP.connection_hashes(df.repartition(7).orderBy("database")))
    for changed in (many["wide"][:-1], many["wide"] + [many["wide"][0]], many["wide"][:-1] + [conn("sql", "other", "499", None)]):
        assert hashes(FP.connection_hashes(frame(spark, {"wide": changed})))["wide"] != first["wide"]


def test_workspaces_without_connections(spark):
    meta = spark.createDataFrame([("plain", "P", "Workspace"), ("none", None, None)], "id string, name string, type string")
    got = {r.workspace_id: r for r in FP.fingerprints(frame(spark, BY_WS), meta, "t", include_empty=True).collect()}
    assert got["none"].connection_hash == hashlib.sha256(b"").hexdigest()
    assert (got["plain"].workspace_name, got["plain"].workspace_type, got["null"].workspace_name) == ("P", "workspace", "")
    assert "none" not in hashes(FP.fingerprints(frame(spark, BY_WS), meta, "t"))


def prints(spark, *rows):
    return spark.createDataFrame(list(rows), "workspace_id string, workspace_name string, workspace_type string, connection_hash string, last_scan_time string")


def test_upsert_and_diff(spark):
    old = prints(spark, ("a", "A", "t", "h1", "1"), ("b", "B", "t", "h2", "1"), ("c", "C", "t", "h3", "1"))
    new = prints(spark, ("a", None, "t", "h9", "2"), ("b", "B2", "t", "h2", "2"), ("d", "D", "t", "h4", "2"))
    got = {r.workspace_id: tuple(r)[1:] for r in FP.upsert(old, new).collect()}
    assert got == {"a": ("A", "t", "h9", "2"), "b": ("B2", "t", "h2", "2"), "c": ("C", "t", "h3", "1"), "d": ("D", "t", "h4", "2")}
    status = {r.workspace_id: r.status for r in FP.diff(old, new).collect()}
    assert status == {"a": "changed", "b": "unchanged", "c": "absent", "d": "new"}


TIMES = [("r", "2024-01-30T22:00:00.0000000Z"), ("o", "2024-01-29T23:00:00+00:00"), ("bad", "soon"), ("no", None), ("edge", "2024-01-30T00:00:00Z")]


@pytest.mark.parametrize("extra, least, kept", [
    (0, 0, {"o", "bad", "no", "edge"}), (0, 5, {"r", "o", "bad", "no", "edge"}), (3, 5, {"o", "bad", "no", "edge", "x0", "x1", "x2"}),
])
def test_recent_scans_are_skipped(spark, extra, least, kept):
    stored = prints(spark, *[(w, "", "", "", t) for w, t in TIMES])
    ids = [w for w, _ in TIMES] + [f"x{i}" for i in range(extra)]
    cands = spark.createDataFrame([(i,) for i in ids], "workspace_id string")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    assert {r.workspace_id for r in FP.skip_recent(cands, stored, now, min_candidates=least).collect()} == kept
    red = FP.skip_reduction(cands, stored, now, min_candidates=least).first()
    assert (red.candidates, red.to_scan) == (len(ids), len(kept))
