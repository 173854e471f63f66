"""Activity kept as sketches and as a stream of tiles; rules and reports by their SQL names."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from test_merge import frame, row

from linkledger.operators import activity as A
from linkledger.operators import activity_sketches as AS
from linkledger.plans import sql_names as SQ
from linkledger.schemas import ACTIVITY_DDL
from linkledger.streaming import activity as SA
from pyspark.sql import functions as F

START = datetime(2024, 1, 1)


def events(spark, n=3000, days=10, seed=3):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        at = START + timedelta(seconds=rng.randrange(86_400 * days))
        user = f"u{min(int(rng.expovariate(0.02)), 900)}" if rng.random() < 0.95 else None
        rows.append((rng.choice(["ViewReport", "GetDataset", "ExecuteQueries"]), at.isoformat() + "Z", user, f"10.0.0.{rng.randrange(250)}",
                     "python", rng.choice(["a", "b", None]), None, None, None, None, None, None))
    rows += [("ViewReport", "no time", "u1", "x", "python", "a", *[None] * 6), ("ViewReport", None, "u1", "x", "python", "a", *[None] * 6)]
    return A.inbound(spark.createDataFrame(rows, ACTIVITY_DDL.removeprefix("struct<").removesuffix(">").replace(":", " ")))


def in_window(df, start, end):
    at = F.try_to_timestamp("timestamp")
    return df.filter((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))


@pytest.mark.parametrize("start, end", [
    ("2024-01-02 00:00:00", "2024-01-09 00:00:00"), ("2024-01-02 07:30:00", "2024-01-08 19:00:00"), ("2024-01-03 01:00:00", "2024-01-03 02:00:00"),
    ("2024-02-01 00:00:00", "2024-02-02 00:00:00"),
])
def test_sketched_windows(spark, tmp_path, start, end):
    df = events(spark).cache()
    AS.store(AS.daily(df), f"{tmp_path}/s")
    AS.store(AS.daily(in_window(df, "2024-01-04", "2024-01-05")), f"{tmp_path}/s")  # a day once more
    stored = AS.read(spark, f"{tmp_path}/s")
    assert stored.count() == 11
    some = in_window(df, start, end)
    joined = AS.window(stored, df, start, end)
    got, want = AS.summary(joined).first(), A.summary(some).first()
    assert (got.calls or 0) == want.calls
    for c in ("users", "ips", "workspaces"):
        assert abs((got[c] or 0) - want[c]) <= AS.WITHIN * want[c] + 1
    exact = some.filter("user IS NOT NULL").groupBy("user").count().orderBy(F.desc("count"), "user").limit(10).collect()
    assert [tuple(r) for r in AS.top(joined, some, "user").collect()] == [tuple(r) for r in exact]
    assert [tuple(r) for r in AS.top(joined, some, "activity").collect()] == [tuple(r) for r in A.top_activities(some).collect()]


def test_many_values_are_counted_in_full_when_the_sketch_cannot_tell(spark, monkeypatch):
    monkeypatch.setattr(AS, "COUNTERS", 64)
    df = spark.range(2000).selectExpr("concat('u', id) AS user", "'ViewReport' AS activity", "'2024-01-01T00:00:00Z' AS timestamp", "'i' AS client_ip", "'w' AS workspace_id")
    joined = AS.window(AS.daily(df), df, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert [r.user for r in AS.top(joined, df, "user", n=3).collect()] == ["u0", "u1", "u10"]


def page(path, name, *times):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(json.dumps({"activityEventEntities": [{"Activity": "ViewReport", "CreationTime": t} for t in times]}) + "\n")


def test_late_and_unordered_events(spark, tmp_path):
    raw, out, cp = (f"{tmp_path}/{n}" for n in ("raw", "out", "cp"))

    def run():
        SA.stage_tiles(SA.read_page_stream(spark, raw, files_per_trigger=1), out, cp, delay="2 hours")
        return {str(r.tile_start)[:10]: (r.events, r.late) for r in SA.read_tiles(spark, out).collect()}

    os.makedirs(raw)
    assert run() == {}
    page(raw, "a.txt", "2024-01-01T23:30:00Z", "2024-01-01T01:00:00Z", "2024-01-02T00:30:00Z", "never")
    assert run() == {"2024-01-01": (2, 0), "2024-01-02": (1, 0)}
    page(raw, "b.txt", "2024-01-01T22:00:00Z")  # out of order, the tile is still open
    assert run() == {"2024-01-01": (3, 0), "2024-01-02": (1, 0)}
    page(raw, "c.txt", "2024-01-02T12:00:00Z")  # the watermark closes the first tile
    run()
    page(raw, "d.txt", "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z", "2024-01-02T09:00:00Z")
    want = {"2024-01-01": (3, 2), "2024-01-02": (3, 0)}
    assert run() == want and run() == want
    tiles = SA.day_tiles(SA.read_tiles(spark, out), F.lit("2024-01-04").cast("timestamp"), days=3).orderBy("tile").collect()
    assert [(r.tile, r.events, r.late) for r in tiles] == [(0, 3, 2), (1, 3, 0), (2, 0, 0)]


def test_rules_and_reports_have_sql_names(spark):
    SQ.register_rules(spark)
    got = spark.sql("SELECT connection_direction('Snowflake', NULL, NULL), connection_direction('x', 'onelake1.windows.net', ''), "
                    "connection_target('s', '', 'e'), is_cloud_connection('x', 's3')").first()
    assert tuple(got) == ("outbound", "unknown", "Server: s | Endpoint: e", True)
    frame(spark, row(con="s3", workspace_users="me, you", item_name="n"), row(ws="v", con="x", cloud=False)).createOrReplaceTempView("named_inventory")
    SQ.register_reports(spark, "named_inventory")
    assert [tuple(r) for r in spark.sql("SELECT * FROM connector_counts(false) ORDER BY 1").collect()] == [("s3", 1), ("x", 1)]
    assert spark.sql("SELECT * FROM connector_counts(true)").count() == 1
    assert spark.sql("SELECT item_name FROM connections_of_owner('you')").first()[0] == "n"
    named = spark.sql("SELECT * FROM connections_by_direction('outbound')")
    assert named.count() == 1 and "Python" not in named._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        SQ.register_reports(spark, "x; DROP TABLE y")
