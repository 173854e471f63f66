"""The registered queries: every operator run over the star-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkledger.adapters import star
from linkledger.functions import fixed_values as V
from linkledger.functions import scalars as X
from linkledger.operators import activity as A
from linkledger.operators import activity_sketches as AS
from linkledger.operators import capacity as C
from linkledger.operators import digest_tree as DT
from linkledger.operators import drift as DR
from linkledger.operators import direction as D
from linkledger.operators import fingerprint as FP
from linkledger.operators import flatten as FL
from linkledger.operators import history as H
from linkledger.operators import merge as M
from linkledger.operators import requests as Q
from linkledger.operators import scanplan as N
from linkledger.operators import sidecar as SC
from linkledger.plans import jobs as J
from linkledger.plans import reports as R
from linkledger.plans import sql_names as SQ
from linkledger.schemas import CONNECTION_KEY
from linkledger.sinks import history as HS
from linkledger.sinks import lookup as L
from linkledger.sinks import scratch
from linkledger.sinks import snapshots as S
from linkledger.sinks import tables as TB
from linkledger.sinks import text_index as TI
from linkledger.sinks import versions as V2
from linkledger.sources import inventory as I
from linkledger.sources import payloads as P
from linkledger.sources import workspaces as W
from linkledger.streaming import activity as SA
from linkledger.streaming import ingest as ST

Query = Callable[[SparkSession, str], DataFrame]

FIRST, SECOND = "2024-01-30", "2024-01-31"
FIRST_TIME, SECOND_TIME = "2024-01-30T00:00:00+00:00", "2024-01-31T00:00:00+00:00"
STORED_UNTIL = "2001-10-01"
CURRENT_SINCE = "1995-02-01"

_saved: dict[tuple[str, str], str] = {}


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """The curated inventory: saved once per application and input, then read like any table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _saved:
        base = scratch.scratch_dir(spark, "inventory")
        TB.save_inventory(star.connections(spark, sf), base)
        _saved[key] = base
    return I.read_inventory(spark, _saved[key])


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    return P.payload_roots(star.documents(spark, sf))


def _land_text(docs: DataFrame, path: str, scan_date: str, scan_time: str | None = None) -> None:
    """Documents as lines of files, under the date (and time) of their scan."""
    folder = f"{path}/scan_date={scan_date}" + (f"/scan_time={scan_time}" if scan_time else "")
    docs.select("text").write.option("compression", "gzip").option("maxRecordsPerFile", TB.PER_FILE).text(folder)


def _flattened_once(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The connections of documents without copies, from rows landed first."""
    rows, path = FL.flatten_payloads(P.payload_roots(docs)), scratch.scratch_dir(spark, "rows")
    rows.write.options(**scratch.DENSE).parquet(path)
    return M.by_workspace(M.dedup, spark.read.schema(rows.schema).parquet(path))


def _existing(spark: SparkSession, sf: str) -> DataFrame:
    return star.connections(spark, sf, until=star.CUTOFF)


def _incoming(spark: SparkSession, sf: str) -> DataFrame:
    return star.connections(spark, sf, since=star.OVERLAP, name_suffix=" v2")


def _workspaces(spark: SparkSession, sf: str) -> DataFrame:
    return star.workspaces(spark, sf).drop("custkey")


def _sidecar(spark: SparkSession, sf: str) -> DataFrame:
    return SC.build_sidecar(star.workspaces_with_users(spark, sf))


def _returned(spark: SparkSession, sf: str) -> DataFrame:
    """Sidecar of the workspaces a scan returned: those with items."""
    seen = star.items(spark, sf).select("custkey").distinct()
    return SC.build_sidecar(star.workspaces_with_users(spark, sf).join(seen, "custkey", "left_semi"))


def _stored_prints(spark: SparkSession, sf: str) -> DataFrame:
    return FP.fingerprints(
        star.connections(spark, sf, until=STORED_UNTIL), _workspaces(spark, sf), "2024-01-30T00:00:00+00:00"
    )


def _current_prints(spark: SparkSession, sf: str) -> DataFrame:
    return FP.fingerprints(
        star.connections(spark, sf, since=CURRENT_SINCE), _workspaces(spark, sf), "2024-01-31T00:00:00+00:00"
    )


# --- sources ------------------------------------------------------------------------------

def scan_payload_dir(spark, sf):
    path = scratch.scratch_dir(spark, "payloads")
    _land_text(star.documents(spark, sf, broken=True), path, FIRST)
    return _flattened_once(spark, P.read_payload_text(spark, path, glob="*.txt.gz", per_line=True))


def payload_rejects(spark, sf):
    return P.payload_rejects(star.documents(spark, sf, broken=True))


def payload_root_normalise(spark, sf):
    """Documents by root shape and the usable payloads they hold."""
    per_file = P.payloads_per_document(star.documents(spark, sf, broken=True))
    # A split document counts once, by its file name.
    name = F.element_at(F.split("path", "/"), -1)
    return per_file.groupBy(name.alias("path"), "is_list").agg(F.min("payloads").alias("payloads"))


def workspace_source(spark, sf):
    return W.shape_workspace_source(star.workspace_source(spark, sf), include_personal=False)


def workspace_source_path(spark, sf):
    """The same source found by its name under the curated folder."""
    base = scratch.scratch_dir(spark, "curated")
    star.workspace_source(spark, sf).write.parquet(f"{base}/my_workspaces.parquet")
    return W.read_workspace_source(spark, "my_workspaces", base, include_personal=False)


def workspace_source_quality(spark, sf):
    return W.source_quality(star.workspace_source(spark, sf))


def workspace_list_normalise(spark, sf):
    """List responses, alternately bare and wrapped, some with an entry that is no object."""
    page = F.floor(F.monotonically_increasing_id() / 200)
    entry = F.struct("id", "name", "type", "capacityId", "capacityName", "isOnDedicatedCapacity")
    lists = star.workspaces(spark, sf).groupBy(page.alias("page")).agg(F.to_json(F.collect_list(entry)).alias("l"))
    text = F.when(F.col("page") % 3 == 0, F.col("l")).when(
        F.col("page") % 3 == 1, F.concat(F.lit('{"workspaces":'), F.col("l"), F.lit("}"))
    ).otherwise(F.concat(F.lit('["x",'), F.expr("substring(l, 2)")))
    return P.workspace_list(lists.select(text.alias("text")))


def modified_since(spark, sf):
    """Workspaces with an item dated at or after T; the test reaches the parquet scan."""
    orders = star.table(spark, sf, "orders").select("o_custkey", "o_orderdate")
    recent = W.modified_since(orders, star.stamp("2001-06-01"), "o_orderdate")
    return recent.groupBy(F.concat(F.lit("ws-"), F.col("o_custkey").cast("string")).alias("workspace_id")).agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("modified")
    )


def lookback_window(spark, sf):
    """Workspaces inside each kind of look-back window."""
    ws, now, at = star.workspaces(spark, sf), star.as_of(), F.col("modified")
    return ws.agg(
        F.count_if(at >= W.lookback_start(now, hours=3)).alias("last_3_hours"),
        F.count_if(at >= W.lookback_start(now, days=1.5)).alias("last_1_5_days"),
        F.count_if(at >= W.lookback_start(now)).alias("by_default"),
        F.count_if(at >= W.lookback_start(now, hours=6, days=3)).alias("hours_win"),
    )


def scan_by_id(spark, sf):
    """One finished scan, landed as ``scan-1.json``, picked up by its id and merged into an earlier inventory."""
    work = scratch.scratch_dir(spark, "by-id")
    for scan_id in ("scan-0", "scan-1"):
        docs = P.documents_of_scan(star.documents(spark, sf), scan_id)
        bare = F.when(F.startswith("text", F.lit("[")), F.expr("substring(text, 2, length(text) - 2)")).otherwise(F.col("text"))
        TB.land_scan(docs.select(bare.alias("text")), f"{work}/raw", scan_id)
    TB.save_inventory(_existing(spark, sf), f"{work}/curated")
    J.scan_by_id(spark, f"{work}/raw", "scan-1", f"{work}/curated")
    return I.read_inventory(spark, f"{work}/curated")


def scan_dir_two_scans(spark, sf):
    """Two dated scans under one folder over an older inventory: of each workspace the later one counts, as a whole."""
    work = scratch.scratch_dir(spark, "two-scans")
    TB.save_inventory(star.connections(spark, sf, name_suffix=" v0"), f"{work}/curated")
    _land_text(star.documents(spark, sf), f"{work}/raw", FIRST)
    _land_text(star.documents(spark, sf, rescan=True), f"{work}/raw", SECOND)
    J.scan_directory(spark, f"{work}/raw", f"{work}/curated", glob="*.txt.gz", per_line=True)
    return I.read_inventory(spark, f"{work}/curated")


def _landed_events(spark, sf) -> str:
    """Where the activity log is landed by date: once per application and input, like the inventory."""
    key = (spark.sparkContext.applicationId, f"events of {sf}")
    if key not in _saved:
        path = scratch.scratch_dir(spark, "events")
        A.land_events(A.unnest_pages(star.activity_pages(spark, sf)), path)
        _saved[key] = path
    return _saved[key]


def activity_events(spark, sf):
    return A.read_events(spark, _landed_events(spark, sf), star.as_of(), days=20)


def activity_filtered(spark, sf):
    """One activity of the last 20 days, from events landed by date."""
    return A.read_events(spark, _landed_events(spark, sf), star.as_of(), days=20, activity="ViewReport")


def activity_by_day_tile(spark, sf):
    events = A.read_events(spark, _landed_events(spark, sf), star.as_of(), days=30, keep_time=True)
    tiles = A.day_tiles(events, star.as_of(), days=30)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return tiles.select(
        "tile", F.date_format("tile_start", fmt).alias("tile_start"),
        F.date_format("tile_end", fmt).alias("tile_end"), "events",
    )


# --- flattening ---------------------------------------------------------------------------

def flatten_all(spark, sf):
    return FL.flatten_payloads(_payloads(spark, sf))


def _flatten_kinds(*kinds: str) -> Query:
    return lambda spark, sf: FL.flatten_payloads(_payloads(spark, sf), kinds=kinds)


def flatten_other_items(spark, sf):
    items = FL.explode_items(FL.explode_workspaces(_payloads(spark, sf)))
    return FL.connection_rows(FL.explode_refs(FL.other_kinds(items)))


def flatten_stats(spark, sf):
    return FL.flatten_stats(_payloads(spark, sf))


def legacy_dataset_count(spark, sf):
    """The older layout, ``datasets`` under the workspace, built from semantic models."""
    its = star.items(spark, sf).filter(F.col("kind").isin(*V.SEMANTIC_TYPES))
    rows = its.join(star.references(spark, sf), "orderkey")
    chunk = F.floor(F.col("_at") / 2000)
    source = F.struct(F.when(F.col("line") % 5 != 0, F.col("ref.connectionDetails")).alias("connectionDetails"))
    docs = rows.groupBy(chunk).agg(F.to_json(F.struct(F.array(F.struct(F.array(F.struct(
        F.collect_list(source).alias("datasources"))).alias("datasets"))).alias("workspaces"))).alias("text"))
    return P.legacy_datasource_count(docs)


def cloud_flag(spark, sf):
    return star.connections(spark, sf).groupBy("connection_scope", "connector").agg(
        F.count_if("cloud").alias("cloud_rows"), F.count_if(~F.col("cloud")).alias("other_rows")
    )


def build_target(spark, sf):
    rows = star.connections(spark, sf).selectExpr(f"{X.build_target('server', 'database', 'endpoint')} AS target")
    return rows.groupBy("target").agg(F.expr("count(1) AS n"))


def workspace_sidecar(spark, sf):
    return SC.build_sidecar(SC.payload_workspaces(_payloads(spark, sf)))


def workspace_owners_list(spark, sf):
    ws = star.workspaces_with_users(spark, sf)
    return ws.selectExpr("id AS workspace_id", f"{SC.owners('users')} AS workspace_users")


def capacity_metadata(spark, sf):
    label = SC.capacity_label("capacityId", "capacityName", "isOnDedicatedCapacity")
    return star.workspaces(spark, sf).selectExpr(
        "id AS workspace_id", "capacityId AS capacity_id", f"{label} AS capacity_name",
        "isOnDedicatedCapacity AS is_dedicated_capacity",
    )


def _sidecar_profile(profile: str) -> Query:
    return lambda spark, sf: SC.build_sidecar(star.workspaces_with_users(spark, sf), profile)


def sidecar_lookup(spark, sf):
    return SC.lookup(star.workspaces(spark, sf).select("id", "name", "type"), _returned(spark, sf))


def sidecar_backfill(spark, sf):
    return SC.backfill(_returned(spark, sf), star.workspaces(spark, sf).select("id", "name", "type"))


# --- de-duplication and merging --------------------------------------------------------------

def dedup_k6(spark, sf):
    return M.dedup(star.connections(spark, sf))


def merge_keep_existing(spark, sf):
    return M.merge(_existing(spark, sf), _incoming(spark, sf), keep="existing")


def merge_keep_incoming(spark, sf):
    return M.merge(_existing(spark, sf), _incoming(spark, sf), keep="incoming")


def merge_chunked(spark, sf):
    """Three overlapping chunks of one scan, merged in one go; the last chunk wins."""
    chunks = [
        star.connections(spark, sf, until="1998-01-01"),
        star.connections(spark, sf, since="1997-01-01", until="2000-01-01", name_suffix=" c2"),
        star.connections(spark, sf, since="1999-01-01", name_suffix=" c3"),
    ]
    return M.merge_all(chunks)


def _snapshot(change: str) -> Query:
    def run(spark, sf):
        d = M.snapshot_diff(_existing(spark, sf), _incoming(spark, sf))
        return d.filter(F.col("change") == change).select(*CONNECTION_KEY)
    return run


def duplicate_check(spark, sf):
    return M.duplicates(star.connections(spark, sf))


# --- sinks ------------------------------------------------------------------------------------

def save_inventory(spark, sf):
    """Save one snapshot, merge another into it, read the result back."""
    base = scratch.scratch_dir(spark, "save")
    TB.save_inventory(_existing(spark, sf), base)
    TB.save_inventory(_incoming(spark, sf), base, mode="merge")
    return I.read_inventory(spark, base)


_ODD_NAME = (
    "CASE CAST(substr(item_id, 4) AS bigint) % 6 WHEN 0 THEN concat(item_name, chr(10), '\"x\", y') WHEN 1 THEN '' "
    "WHEN 2 THEN NULL WHEN 3 THEN concat(' ', item_name, ',') WHEN 4 THEN concat(chr(92), item_name, '\"') ELSE item_name END AS item_name"
)


def save_inventory_csv(spark, sf):
    """Round trip through the CSV copy, with line breaks, quotes, commas, empty text and nulls in names."""
    path = scratch.scratch_dir(spark, "csv")
    inv = inventory(spark, sf)
    rows = inv.selectExpr(*[_ODD_NAME if c == "item_name" else c for c in inv.columns])
    TB.save_csv(rows, path)
    return TB.read_csv(spark, path, rows.schema)


def save_registered_table(spark, sf):
    """A registered table, merged into twice and read by its name."""
    base, name = scratch.scratch_dir(spark, "registered"), f"inventory_{uuid.uuid4().hex}"
    TB.save_inventory(_existing(spark, sf), base, table=name)
    TB.save_inventory(_incoming(spark, sf), base, table=name, mode="merge")
    TB.save_inventory(_incoming(spark, sf), base, table=name, mode="merge")
    return I.read_inventory(spark, name)


def save_partitioned(spark, sf):
    """An inventory in hash partitions, merged into."""
    base = scratch.scratch_dir(spark, "partitioned")
    TB.merge_partitioned(_existing(spark, sf), base, parts=8)
    TB.merge_partitioned(_incoming(spark, sf), base)
    return I.read_inventory(spark, base)


def create_table_as(spark, sf):
    name = f"workspaces_{uuid.uuid4().hex}"
    TB.create_table_as(R.workspace_inventory(inventory(spark, sf)), name)
    return spark.table(name)


def analysis_saved(spark, sf):
    """Inbound access as the direction analysis saves it, read from its CSV."""
    path = scratch.scratch_dir(spark, "analysis")
    _, inbound = J.analyse_direction(inventory(spark, sf), star.activity_events(spark, sf), star.as_of(), 30, path)
    return TB.read_csv(spark, f"{path}/inbound_api_activity/csv", inbound.schema)


def payload_roundtrip(spark, sf):
    base = scratch.scratch_dir(spark, "raw")
    landed = _payloads(spark, sf).select(
        F.when(F.pmod(F.xxhash64("path"), F.lit(2)) == 0, F.lit("full")).otherwise(F.lit("incremental")).alias("scan_kind"),
        F.lit(FIRST).alias("scan_date"), "payload",
    )
    TB.land_payloads(landed, base, "gzip")
    docs = P.read_payload_text(spark, base, "*.json.gz", per_line=True, since=FIRST)
    return _flattened_once(spark, docs)


def connections_with_direction(spark, sf):
    return J.analyse_direction(inventory(spark, sf))[0].select(*CONNECTION_KEY, "direction")


def _run_stream(spark, work: str) -> None:
    stream = ST.read_payload_stream(spark, f"{work}/raw", glob="*.txt.gz", per_line=True)
    ST.stage_increments(stream, f"{work}/increments", f"{work}/checkpoint")


def stream_ingest_merge(spark, sf):
    """Land documents, stream them in micro-batches, merge the increments once."""
    work = scratch.scratch_dir(spark, "stream")
    _land_text(star.documents(spark, sf, broken=True), f"{work}/raw", FIRST)
    _run_stream(spark, work)
    ST.merge_increments(spark, f"{work}/increments", f"{work}/curated")
    return I.read_inventory(spark, f"{work}/curated")


def stream_two_runs(spark, sf):
    """The same workspaces landed twice, the second time with fewer connections; a third run finds nothing new."""
    work = scratch.scratch_dir(spark, "stream")
    for scan, rescan in ((FIRST, False), (SECOND, True), (None, False)):
        if scan:
            _land_text(star.documents(spark, sf, rescan=rescan), f"{work}/raw", scan)
        _run_stream(spark, work)
        ST.merge_increments(spark, f"{work}/increments", f"{work}/curated")
    return I.read_inventory(spark, f"{work}/curated")


def stream_fingerprints(spark, sf):
    """Repeated updates: fingerprints refreshed from streamed increments over stored ones."""
    work = scratch.scratch_dir(spark, "stream")
    _land_text(star.documents(spark, sf), f"{work}/raw", FIRST)
    S.write_snapshot(_stored_prints(spark, sf), f"{work}/hashes")
    _run_stream(spark, work)
    ST.update_fingerprints(spark, f"{work}/increments", _workspaces(spark, sf), SECOND_TIME, f"{work}/hashes")
    return I.read_fingerprints(spark, f"{work}/hashes")


def stream_fingerprints_rescan(spark, sf):
    """The same content scanned twice: hashes stay as they were."""
    work = scratch.scratch_dir(spark, "stream")
    for scan, time in ((FIRST, FIRST_TIME), (SECOND, SECOND_TIME)):
        _land_text(star.documents(spark, sf), f"{work}/raw", scan)
        _run_stream(spark, work)
        ST.update_fingerprints(spark, f"{work}/increments", _workspaces(spark, sf), time, f"{work}/hashes")
    return I.read_fingerprints(spark, f"{work}/hashes")


def scan_dir_rejects(spark, sf):
    """What a job over landed files could not use, by reason; a second run over them reports the same."""
    work = scratch.scratch_dir(spark, "rejects")
    _land_text(star.documents(spark, sf, broken=True), f"{work}/raw", FIRST)
    J.scan_directory(spark, f"{work}/raw", f"{work}/curated", glob="*.txt.gz", per_line=True, rejects=f"{work}/rejects")
    J.scan_directory(spark, f"{work}/raw", f"{work}/curated", glob="*.txt.gz", per_line=True, rejects=f"{work}/rejects")
    return J.read_rejects(spark, f"{work}/rejects").groupBy("reason", "position").agg(F.sum("n").alias("n"))


def scan_dir_partitioned(spark, sf):
    """Landed files into an inventory kept in hash partitions."""
    work = scratch.scratch_dir(spark, "partitions")
    _land_text(star.documents(spark, sf), f"{work}/raw", FIRST)
    J.scan_directory(spark, f"{work}/raw", f"{work}/curated", glob="*.txt.gz", per_line=True, partitions=8)
    return I.read_inventory(spark, f"{work}/curated")


def _stored_times(spark, sf, path: str) -> None:
    S.write_snapshot(star.stored_times(spark, sf).select(
        "workspace_id", F.lit("").alias("workspace_name"), F.lit("").alias("workspace_type"),
        F.lit("").alias("connection_hash"), "last_scan_time",
    ), path)


def incremental_update(spark, sf):
    """Modified workspaces that were not scanned lately, refreshed in the earlier inventory."""
    work = scratch.scratch_dir(spark, "incremental")
    TB.save_inventory(_existing(spark, sf), f"{work}/curated")
    _stored_times(spark, sf, f"{work}/hashes")
    J.incremental_update(
        star.documents(spark, sf), _workspaces(spark, sf), W.lookback_start(star.as_of(), days=2), star.as_of(),
        SECOND_TIME, f"{work}/curated", f"{work}/hashes", include_personal=False,
    )
    return I.read_inventory(spark, f"{work}/curated")


def incremental_replace(spark, sf):
    """Two landed scans; the newer one replaces what the workspaces had, and empties some."""
    work = scratch.scratch_dir(spark, "incremental")
    TB.save_inventory(star.connections(spark, sf, name_suffix=" v1"), f"{work}/curated")
    _stored_times(spark, sf, f"{work}/hashes")
    _land_text(star.documents(spark, sf), f"{work}/raw", FIRST)
    _land_text(star.documents(spark, sf, rescan=True), f"{work}/raw", SECOND)
    docs = P.read_payload_text(spark, f"{work}/raw", glob="*.txt.gz", per_line=True, since=FIRST)
    J.incremental_update(
        docs, _workspaces(spark, sf), W.lookback_start(star.as_of(), days=2), star.as_of(), SECOND_TIME,
        f"{work}/curated", f"{work}/hashes", include_personal=False,
    )
    return I.read_inventory(spark, f"{work}/curated")


def incremental_same_day(spark, sf):
    """Two scans of one day, told apart by their times: what the later one lacks is gone, from connections and hashes."""
    work = scratch.scratch_dir(spark, "same-day")
    _land_text(star.documents(spark, sf), f"{work}/raw", FIRST, "080000")
    _land_text(star.documents(spark, sf, rescan=True), f"{work}/raw", FIRST, "140000")
    J.incremental_update(
        P.read_payload_text(spark, f"{work}/raw", glob="*.txt.gz", per_line=True), _workspaces(spark, sf),
        W.lookback_start(star.as_of(), days=30), star.as_of(), SECOND_TIME, f"{work}/curated", f"{work}/hashes",
    )
    counts = I.read_inventory(spark, f"{work}/curated").groupBy("workspace_id").agg(F.count(F.lit(1)).alias("connections"))
    prints = I.read_fingerprints(spark, f"{work}/hashes").select("workspace_id", "connection_hash")
    return prints.join(counts, "workspace_id", "left").withColumn("connections", F.coalesce("connections", F.lit(0).cast("long")))


def stream_same_day_rescan(spark, sf):
    """The same content scanned twice on one day, in two runs of the stream: hashes stay as they were."""
    work = scratch.scratch_dir(spark, "stream")
    for clock, time in (("080000", FIRST_TIME), ("140000", SECOND_TIME)):
        _land_text(star.documents(spark, sf), f"{work}/raw", FIRST, clock)
        _run_stream(spark, work)
        ST.update_fingerprints(spark, f"{work}/increments", _workspaces(spark, sf), time, f"{work}/hashes")
    return I.read_fingerprints(spark, f"{work}/hashes")


def stream_duplicate_landing(spark, sf):
    """Every document of a scan landed twice, under other names and in another run: each counts once in the hashes."""
    work = scratch.scratch_dir(spark, "stream")
    docs = star.documents(spark, sf).select("text")
    docs.write.option("compression", "gzip").text(f"{work}/docs")  # read one by one, unlike columns
    for again in ("a", "b"):
        spark.read.text(f"{work}/docs").write.option("compression", "gzip").text(f"{work}/raw/scan_date={FIRST}/{again}")
        stream = ST.read_payload_stream(spark, f"{work}/raw", glob="*.txt.gz", per_line=True, replays_within="7 days")
        ST.stage_increments(stream, f"{work}/increments", f"{work}/checkpoint")
    ST.update_fingerprints(spark, f"{work}/increments", _workspaces(spark, sf), SECOND_TIME, f"{work}/hashes")
    return I.read_fingerprints(spark, f"{work}/hashes")


# --- history and versions ---------------------------------------------------------------------

SCANS = ("2024-01-29", "2024-01-30", "2024-01-31")


def _three_scans(spark, sf) -> list[tuple[str, DataFrame, DataFrame]]:
    """Scan, its connections, the workspaces it looked at: all, every other one, two of three."""
    number = F.expr("CAST(substr(workspace_id, 4) AS bigint)")
    ws = _workspaces(spark, sf).select(F.col("id").alias("workspace_id"))
    found = [star.connections(spark, sf, until=star.CUTOFF), _incoming(spark, sf), _incoming(spark, sf)]
    looked = [F.lit(True), number % 2 == 0, number % 3 != 0]
    return [(s, rows.filter(some), ws.filter(some)) for s, rows, some in zip(SCANS, found, looked, strict=True)]


def connection_history(spark, sf):
    """From when to when every connection was there, over three scans."""
    rows = seen = None
    for scan, found, looked in _three_scans(spark, sf):
        found, looked = found.withColumn("scan", F.lit(scan)), looked.withColumn("scan", F.lit(scan))
        rows, seen = (found, looked) if rows is None else (rows.unionByName(found), seen.unionByName(looked))
    return H.history(rows, seen)


def _recorded(spark, sf) -> str:
    base = scratch.scratch_dir(spark, "history")
    for scan, found, looked in _three_scans(spark, sf):
        HS.record_scan(found, looked, scan, base)
    return base


def history_recorded(spark, sf):
    """The same history, kept scan by scan."""
    return HS.read_history(spark, _recorded(spark, sf))


def inventory_as_of(spark, sf):
    """The inventory as it was at the second scan, read from the history after the third."""
    return HS.read_as_of(spark, _recorded(spark, sf), SCANS[1])


def snapshot_between(spark, sf):
    """What changed between the first and the third of four stored versions."""
    base = scratch.scratch_dir(spark, "versions")
    V2.save_version(_existing(spark, sf), base, buckets=8)
    V2.merge_version(_incoming(spark, sf).filter("cloud"), base)
    V2.merge_version(_incoming(spark, sf), base)
    V2.merge_version(_existing(spark, sf), base)
    return V2.diff_versions(spark, base, 1, 3)


def version_merged(spark, sf):
    """A version merged with the connections of every other workspace, which replace theirs."""
    base = scratch.scratch_dir(spark, "versions")
    even = F.expr("CAST(substr(workspace_id, 4) AS bigint) % 2 = 0")
    V2.save_version(_existing(spark, sf), base, buckets=8)
    scanned = _workspaces(spark, sf).select(F.col("id").alias("workspace_id")).filter(even)
    V2.merge_version(_incoming(spark, sf).filter(even), base, scanned)
    return V2.read_version(spark, base).drop(V2.ID)


# --- fingerprints -----------------------------------------------------------------------------

def fingerprint_build(spark, sf):
    """Of all connections of every workspace."""
    return FP.fingerprints(star.connections(spark, sf), _workspaces(spark, sf), "2024-01-31T00:00:00+00:00")


def fingerprint_upsert(spark, sf):
    return FP.upsert(_stored_prints(spark, sf), _current_prints(spark, sf))


def fingerprint_diff(spark, sf):
    return FP.diff(_stored_prints(spark, sf), _current_prints(spark, sf))


def _candidates(spark, sf):
    since = W.lookback_start(star.as_of(), days=3)
    return W.modified_since(_workspaces(spark, sf), since).select(F.col("id").alias("workspace_id"))


def recent_scan_skip(spark, sf):
    return FP.skip_recent(_candidates(spark, sf), star.stored_times(spark, sf), star.as_of())


def recent_scan_reduction(spark, sf):
    return FP.skip_reduction(_candidates(spark, sf), star.stored_times(spark, sf), star.as_of())


def fingerprint_drilldown(spark, sf):
    """Items that differ between two scans, found through the workspaces that do."""
    base = scratch.scratch_dir(spark, "trees")
    DT.save_tree(star.connections(spark, sf, until=STORED_UNTIL), f"{base}/old", parts=16)
    DT.save_tree(star.connections(spark, sf, since=CURRENT_SINCE), f"{base}/new", parts=16)
    return DT.drilldown(spark, f"{base}/old", f"{base}/new")


def stream_partitioned(spark, sf):
    """Two scans streamed in two runs into an inventory kept in hash partitions; a third run finds nothing new."""
    work = scratch.scratch_dir(spark, "stream")
    for scan, rescan in ((FIRST, False), (SECOND, True), (None, False)):
        if scan:
            _land_text(star.documents(spark, sf, rescan=rescan), f"{work}/raw", scan)
        _run_stream(spark, work)
        ST.merge_increments(spark, f"{work}/increments", f"{work}/curated", partitions=8)
    return I.read_inventory(spark, f"{work}/curated")


def payload_drift(spark, sf):
    """Fields that the schema doesn't read: every item has one more, and references one that changes its type."""
    text = F.replace("text", F.lit('{"id":"it-'), F.lit('{"newField":{"x":1,"y":["a"]},"id":"it-'))
    return DR.drift(star.documents(spark, sf).withColumn("text", text)).filter("path LIKE 'newField%'")


def owner_search_indexed(spark, sf):
    """Connections of an owner, from the inventory indexed by the trigrams of its owners."""
    base = scratch.scratch_dir(spark, "text-index")
    TI.save_index(inventory(spark, sf), "workspace_users", base, parts=16)
    return TI.search(spark, base, "user1@example.org").select("connector", "target", "workspace_name", "item_name")


def workspace_lookup(spark, sf):
    """The connections of a few workspaces, from an inventory stored for that."""
    path = scratch.scratch_dir(spark, "lookup")
    L.save_lookup(inventory(spark, sf), path)
    few = _workspaces(spark, sf).filter("CAST(substr(id, 4) AS bigint) % 97 = 5").select(F.col("id").alias("workspace_id"))
    return L.lookup(spark, path, few).select(*CONNECTION_KEY)


def workspace_lookup_many(spark, sf):
    """The connections of the workspaces whose last scan left something to do, from the same kind of store."""
    path = scratch.scratch_dir(spark, "lookup")
    L.save_lookup(inventory(spark, sf), path)
    return L.lookup(spark, path, recent_scan_skip(spark, sf)).select(*CONNECTION_KEY)


# --- direction and activity ---------------------------------------------------------------------

def classify_direction(spark, sf):
    rows = D.classify(star.connections(spark, sf))
    return rows.groupBy("connector", "server", "endpoint", "direction").agg(F.count(F.lit(1)).alias("n"))


def direction_counts(spark, sf):
    return D.direction_counts(D.classify(inventory(spark, sf)))


def inbound_activity(spark, sf):
    return A.inbound(A.read_events(spark, _landed_events(spark, sf), star.as_of(), days=30))


def activity_summary(spark, sf):
    return A.summary(inbound_activity(spark, sf))


def activity_top10(spark, sf):
    return A.top_activities(inbound_activity(spark, sf))


def _sketched(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Inbound events of 29.5 days, and these with the whole days' sketches read from where they are stored."""
    path = scratch.scratch_dir(spark, "sketches")
    events = A.inbound(star.activity_events(spark, sf))
    AS.store(AS.daily(events), path)
    return A.inbound(A.in_window(star.activity_events(spark, sf), star.as_of(), days=29.5)), AS.window(
        AS.read(spark, path), events, "2024-01-01 12:00:00", star.AS_OF)


def activity_summary_sketched(spark, sf):
    """The summary from stored sketches: exact calls, distinct counts within their stated error of the exact ones."""
    events, joined = _sketched(spark, sf)
    exact = A.summary(events).select(*[F.col(c).alias(f"exact_{c}") for c in ("calls", "users", "ips", "workspaces")])
    both = AS.summary(joined).join(exact, F.col("calls") == F.col("exact_calls"))
    return both.select("calls", *[AS.distinct_within(c, f"exact_{c}").alias(f"{c}_within") for c in ("users", "ips", "workspaces")])


def _top_sketched(column: str) -> Query:
    def run(spark, sf):
        events, joined = _sketched(spark, sf)
        return AS.top(joined, events, column)
    return run


def stream_day_tiles(spark, sf):
    """Pages landed in three parts, in order of time, streamed one part after the other."""
    work = scratch.scratch_dir(spark, "tiles")
    events = star.activity_events(spark, sf)
    for k, (since, until) in enumerate((("", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "9"))):
        part = events.filter((F.col("CreationTime") >= since) & (F.col("CreationTime") < until))
        star.pages_of(part).write.text(f"{work}/pages/{k}")
        SA.stage_tiles(SA.read_page_stream(spark, f"{work}/pages"), f"{work}/out", f"{work}/checkpoint")
    tiles = SA.day_tiles(SA.read_tiles(spark, f"{work}/out"), star.as_of(), days=30)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return tiles.select(
        "tile", F.date_format("tile_start", fmt).alias("tile_start"), F.date_format("tile_end", fmt).alias("tile_end"), "events", "late")


def direction_sql(spark, sf):
    """The direction rule under its SQL name."""
    SQ.register_rules(spark)
    star.connections(spark, sf).createOrReplaceTempView("linkledger_connections")
    return spark.sql(
        "SELECT connector, server, endpoint, connection_direction(connector, server, endpoint) AS direction, count(1) AS n "
        "FROM linkledger_connections GROUP BY ALL")


def _report_sql(query: str) -> Query:
    def run(spark, sf):
        inventory(spark, sf).createOrReplaceTempView("linkledger_inventory")
        SQ.register_reports(spark, "linkledger_inventory")
        return spark.sql(query)
    return run


# --- capacities and scan plans -------------------------------------------------------------------

def _keyed(spark, sf):
    return C.with_capacity_key(_workspaces(spark, sf))


def capacity_distribution(spark, sf):
    return C.distribution(_keyed(spark, sf))


def capacity_filter(spark, sf):
    kept = C.select_capacities(
        _keyed(spark, sf), include=["cap-00000003", "cap-00000006", "shared", "cap-none"], exclude=["shared"]
    )
    return kept.select("id", "capacity_key")


def capacity_unknown(spark, sf):
    return C.unknown_capacities(_keyed(spark, sf), ["cap-00000003", "cap-none", "shared"])


def capacity_order(spark, sf):
    return C.ordered(
        C.distribution(_keyed(spark, sf)).select("capacity_key", "workspaces"), ["cap-00000012", "shared", "cap-none"]
    )


def _plan(spark, sf):
    return N.plan_batches(_workspaces(spark, sf), max_batches_per_hour=4)


def _completed(spark, sf, plan: DataFrame) -> DataFrame:
    """Batches taken as done: a third or more of their workspaces were scanned in the last day."""
    todo = FP.skip_recent(
        plan.select(F.col("id").alias("workspace_id")), star.stored_times(spark, sf), star.as_of()
    ).select(F.col("workspace_id").alias("id"), F.lit(1).alias("todo"))
    per_batch = plan.join(todo, "id", "left").groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("todo").isNull()).alias("done")
    )
    return per_batch.filter(F.col("done") * 3 >= F.col("n")).select("batch_no")


def scan_plan(spark, sf):
    return _plan(spark, sf).select("id", "seq", "batch_no", "chunk_no")


def scan_plan_full(spark, sf):
    """Personal filter, capacity filter, priority and batches of a full scan."""
    return J.plan_full_scan(
        _workspaces(spark, sf), 4, exclude=["cap-00000003"], priority=["cap-00000012", "shared"], include_personal=False,
        batch_size=10,
    )


def scan_plan_by_capacity(spark, sf):
    plan = N.plan_batches(_keyed(spark, sf), 4, batch_size=10, within="capacity_key")
    return plan.select("id", "capacity_key", "seq", "batch_no", "chunk_no")


def remaining_batches(spark, sf):
    plan = _plan(spark, sf)
    return N.remaining(plan, _completed(spark, sf, plan)).select("id", "batch_no")


def scan_progress(spark, sf):
    plan = _plan(spark, sf)
    return N.progress(plan, _completed(spark, sf, plan), 4)


def scan_estimate(spark, sf):
    return N.estimate(_workspaces(spark, sf), 4)


# --- filters and reports -------------------------------------------------------------------------

def _report(fn: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: fn(inventory(spark, sf), *args, **kwargs)


def exclude_personal(spark, sf):
    return W.exclude_personal(_workspaces(spark, sf), "type").select("id", "type")


def workspace_subset(spark, sf):
    """The connections of the workspaces whose last scan left something to do."""
    return W.subset(inventory(spark, sf), recent_scan_skip(spark, sf)).select(*CONNECTION_KEY)


def workspace_rename(spark, sf):
    return W.rename_source(_workspaces(spark, sf))


def inventory_prod_only(spark, sf):
    return R.production_only(R.workspace_inventory(inventory(spark, sf), include_personal=True))


def inventory_by_capacity(spark, sf):
    return R.on_capacities(
        R.workspace_inventory(inventory(spark, sf), include_personal=True),
        ["PersonalGroup", "Test", "Development"], ["cap-00000003", "cap-00000007"],
    )


def request_rate(spark, sf):
    return Q.request_rate(star.request_log(spark, sf), "day")


def contention_status(spark, sf):
    log = star.request_log(spark, sf).withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    return Q.contention_status(log, "hour")


QUERIES: dict[str, Query] = {
    "scan_payload_dir": scan_payload_dir,
    "payload_rejects": payload_rejects,
    "payload_root_normalise": payload_root_normalise,
    "workspace_source": workspace_source,
    "workspace_source_path": workspace_source_path,
    "workspace_source_quality": workspace_source_quality,
    "workspace_list_normalise": workspace_list_normalise,
    "modified_since": modified_since,
    "lookback_window": lookback_window,
    "scan_by_id": scan_by_id,
    "scan_dir_two_scans": scan_dir_two_scans,
    "activity_events": activity_events,
    "activity_filtered": activity_filtered,
    "activity_by_day_tile": activity_by_day_tile,
    "flatten_all": flatten_all,
    "flatten_semantic_models": _flatten_kinds(*V.SEMANTIC_TYPES),
    "flatten_dataflows": _flatten_kinds(*V.DATAFLOW_TYPES),
    "flatten_activities": _flatten_kinds(*V.ACTIVITY_TYPES),
    "flatten_lakehouse_notebook": _flatten_kinds(*V.REFERENCE_TYPES),
    "flatten_other_items": flatten_other_items,
    "flatten_stats": flatten_stats,
    "legacy_dataset_count": legacy_dataset_count,
    "cloud_flag": cloud_flag,
    "build_target": build_target,
    "workspace_sidecar": workspace_sidecar,
    "sidecar_incremental": _sidecar_profile("incremental"),
    "sidecar_listing": _sidecar_profile("listing"),
    "workspace_owners_list": workspace_owners_list,
    "capacity_metadata": capacity_metadata,
    "sidecar_lookup": sidecar_lookup,
    "sidecar_backfill": sidecar_backfill,
    "dedup_k6": dedup_k6,
    "merge_keep_existing": merge_keep_existing,
    "merge_keep_incoming": merge_keep_incoming,
    "merge_chunked": merge_chunked,
    "snapshot_added": _snapshot("added"),
    "snapshot_removed": _snapshot("removed"),
    "duplicate_check": duplicate_check,
    "save_inventory": save_inventory,
    "save_inventory_csv": save_inventory_csv,
    "save_registered_table": save_registered_table,
    "save_partitioned": save_partitioned,
    "create_table_as": create_table_as,
    "analysis_saved": analysis_saved,
    "scan_dir_rejects": scan_dir_rejects,
    "scan_dir_partitioned": scan_dir_partitioned,
    "payload_roundtrip": payload_roundtrip,
    "connections_with_direction": connections_with_direction,
    "stream_ingest_merge": stream_ingest_merge,
    "stream_two_runs": stream_two_runs,
    "stream_fingerprints": stream_fingerprints,
    "stream_fingerprints_rescan": stream_fingerprints_rescan,
    "incremental_update": incremental_update,
    "incremental_replace": incremental_replace,
    "incremental_same_day": incremental_same_day,
    "stream_same_day_rescan": stream_same_day_rescan,
    "stream_duplicate_landing": stream_duplicate_landing,
    "stream_partitioned": stream_partitioned,
    "payload_drift": payload_drift,
    "owner_search_indexed": owner_search_indexed,
    "workspace_lookup": workspace_lookup,
    "workspace_lookup_many": workspace_lookup_many,
    "connection_history": connection_history,
    "history_recorded": history_recorded,
    "inventory_as_of": inventory_as_of,
    "snapshot_between": snapshot_between,
    "version_merged": version_merged,
    "fingerprint_build": fingerprint_build,
    "fingerprint_drilldown": fingerprint_drilldown,
    "fingerprint_upsert": fingerprint_upsert,
    "fingerprint_diff": fingerprint_diff,
    "recent_scan_skip": recent_scan_skip,
    "recent_scan_reduction": recent_scan_reduction,
    "classify_direction": classify_direction,
    "direction_counts": direction_counts,
    "inbound_activity": inbound_activity,
    "activity_summary": activity_summary,
    "activity_top10": activity_top10,
    "activity_summary_sketched": activity_summary_sketched,
    "activity_top10_sketched": _top_sketched("activity"),
    "user_top10_sketched": _top_sketched("user"),
    "stream_day_tiles": stream_day_tiles,
    "direction_sql": direction_sql,
    "connector_counts_sql": _report_sql("SELECT * FROM connector_counts(true)"),
    "owner_connections_sql": _report_sql("SELECT * FROM connections_of_owner('user1@example.org')"),
    "outbound_sql": _report_sql("SELECT * FROM connections_by_direction('outbound')"),
    "capacity_distribution": capacity_distribution,
    "capacity_coverage": lambda spark, sf: C.coverage(_sidecar(spark, sf)),
    "capacity_filter": capacity_filter,
    "capacity_unknown": capacity_unknown,
    "capacity_order": capacity_order,
    "scan_plan": scan_plan,
    "scan_plan_full": scan_plan_full,
    "scan_plan_by_capacity": scan_plan_by_capacity,
    "remaining_batches": remaining_batches,
    "scan_progress": scan_progress,
    "scan_estimate": scan_estimate,
    "exclude_personal": exclude_personal,
    "workspace_subset": workspace_subset,
    "workspace_rename": workspace_rename,
    "workspace_inventory": _report(R.workspace_inventory),
    "inventory_distinct": _report(R.distinct_connections),
    "inventory_prod_only": inventory_prod_only,
    "inventory_by_capacity": inventory_by_capacity,
    "inventory_totals": _report(R.totals),
    "connector_counts": _report(R.connector_counts),
    "cloud_connector_counts": _report(R.connector_counts, cloud_only=True),
    "connector_summary": _report(R.connector_summary),
    "owner_summary": _report(R.owner_summary),
    "workspace_connection_top20": _report(R.workspace_connections_top),
    "report_cloud_with_owners": _report(R.cloud_with_owners),
    "report_cloud_by_connector": _report(R.cloud_by_connector),
    "report_connector_in": _report(R.of_connectors, ["azuresqldatabase", "synapse", "snowflake"]),
    "report_by_owner_like": _report(R.by_owner, "user1@example.org"),
    "report_recently_modified": _report(R.recently_modified),
    "redacted_summary": _report(R.redacted),
    "request_rate": request_rate,
    "contention_status": contention_status,
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Landed documents to connector counts: parse, flatten, de-duplicate, report."""
    return R.connector_counts(M.dedup(FL.flatten_payloads(_payloads(spark, sf))))


def prepared(query: Query) -> Query:
    """A query with the session set to UTC, which the stored times are in."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf)

    return run
