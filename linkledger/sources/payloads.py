"""Landed scan payloads: reading, root normalisation and rejects.

A payload document is JSON text whose root is one payload object or a list of them.
Documents are parsed with an explicit schema in one streaming pass, so size is bounded
only by what one string can hold. A document with a malformed spot takes a second,
tolerant pass that takes it apart level by level, down to the item that has the spot, and
nulls only that; what still cannot be used is reported by :func:`payload_rejects` instead
of being lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkledger.functions.scalars import quoted
from linkledger.schemas import ITEM_DDL, PAYLOAD_DDL, WORKSPACE_DDL

_PARSE_OPTIONS = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}
_ROOTS_DDL = f"roots array<{PAYLOAD_DDL}>, _bad string"
_BLANK = "' \\t\\r\\n'"


def read_payload_text(
    spark: SparkSession,
    path: str | list[str],
    glob: str = "*.json",
    per_line: bool = False,
    since: str | None = None,
    skip_larger_than: int | None = None,
) -> DataFrame:
    """Documents under ``path`` as ``(path, scan, text)``.

    ``per_line`` reads one document per line: such files split, so their size doesn't matter. A
    file read whole has to fit into one string, else the read fails; ``skip_larger_than`` leaves
    such files to :func:`oversized_files` instead. ``scan`` is told from the folders a
    document landed in, see :func:`scan_of`; ``since`` prunes folders of earlier dates.
    """
    text = spark.read.option("pathGlobFilter", glob).text(path, wholetext=not per_line)
    if since is not None:
        text = text.filter(F.col("scan_date") >= since)
    if skip_larger_than is not None and not per_line:
        text = text.filter(F.col("_metadata.file_size") <= skip_larger_than)
    path = F.col("_metadata.file_path")
    return text.select(path.alias("path"), scan_of(path).alias("scan"), F.col("value").alias("text"))


def scan_of(path: Column) -> Column:
    """The scan that a file belongs to, from its folders: ``scan_date=<date>``, with ``T`` and the time if below it there is a
    ``scan_time=<time>`` (such as ``153000``; scans of one day in the order of their times). Empty without such folders.

    Several scans of a workspace on one day have to land under their times: files of one folder are one scan, whatever
    their number, and their own times don't tell scans apart.
    """
    date, time = (F.regexp_extract(path, f"/scan_{part}=([^/]+)/", 1) for part in ("date", "time"))
    return F.concat(date, F.when(time != "", F.concat(F.lit("T"), time)).otherwise(F.lit("")))


def oversized_files(spark: SparkSession, path: str | list[str], max_bytes: int, glob: str = "*.json") -> DataFrame:
    """Files above ``max_bytes`` as reject rows. Lists files, reads no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.filter(F.col("length") > max_bytes).select(
        "path",
        F.lit(None).cast("int").alias("position"),
        F.lit("too_large").alias("reason"),
        F.lit(1).cast("long").alias("n"),
    )


def _first_character(text: Column) -> Column:
    trimmed = F.ltrim(text, F.expr(_BLANK))
    return F.substring(trimmed, 1, 1)


def _object(text: str, value: str) -> str:
    """``value`` if the JSON text is an object."""
    return f"CASE WHEN startswith(ltrim({_BLANK}, {text}), '{{') THEN {value} END"


# The tolerant pass. Lists are read as lists of texts, which keeps whatever is beside a bad
# spot; only the item that has the spot goes through VARIANT, whose casts null a bad leaf alone.
_WS_FIELDS = {f: f"w.{f}" for f in ("id", "name", "type", "capacityId", "capacityName", "isOnDedicatedCapacity", "modified", "users")}
_WS_TEXT_DDL = WORKSPACE_DDL.replace(f"items:array<{ITEM_DDL}>", "items:array<string>")
_ITEM = _object(
    "t", f"from_json(to_json(named_struct('item', try_variant_get(try_parse_json(t), '$', '{ITEM_DDL}'))), 'item {ITEM_DDL}').item"
)
_ITEMS = f"transform(w.items, t -> {_ITEM})"
_WORKSPACE = (
    "named_struct(" + ", ".join(f"'{n}', {c}" for n, c in _WS_FIELDS.items()) + f", 'items', {_ITEMS})"
)
_WORKSPACES = (
    "transform(transform(p.workspaces, t -> " + _object("t", f"from_json(t, '{_WS_TEXT_DDL}')") + f"), w -> CASE WHEN w IS NOT NULL THEN {_WORKSPACE} END)"
)
_TOLERANT = (
    "transform(transform(from_json(concat('{\"roots\":', _listed, '}'), 'roots array<string>', map('allowSingleQuotes', 'false')).roots, t -> "
    + _object("t", "from_json(t, 'workspaces array<string>, workspace_sidecar string')")
    + f"), p -> CASE WHEN p IS NOT NULL THEN named_struct('workspaces', {_WORKSPACES}, 'workspace_sidecar', "
    "from_json(p.workspace_sidecar, 'map<string,map<string,string>>')) END)"
)


def parse_documents(docs: DataFrame) -> DataFrame:
    """``(path, text)`` to ``(path, scan, digest, is_list, _roots)``, parsed once per document.

    Jobs that need several things of a document land the pieces of this and take roots, rejects and repeats from what they landed.
    """
    is_list = _first_character(F.col("text")) == "["
    # An object root is wrapped into a one-element list, so both kinds share a schema,
    # and text after the document's end becomes a syntax error.
    listed = F.when(is_list, F.col("text")).otherwise(F.concat(F.lit("["), F.col("text"), F.lit("]")))
    strict = F.from_json(F.concat(F.lit('{"roots":'), F.col("_listed"), F.lit("}")), _ROOTS_DDL, _PARSE_OPTIONS)
    scan = F.col("scan") if "scan" in docs.columns else F.lit("").alias("scan")
    parsed = (
        docs.select("path", scan, F.sha2("text", 256).alias("digest"), is_list.alias("is_list"), listed.alias("_listed"))
        .select("path", "scan", "digest", "is_list", "_listed", strict.alias("_strict"))
    )
    roots = F.when(F.col("_strict._bad").isNull(), F.col("_strict.roots")).otherwise(F.expr(_TOLERANT))
    return parsed.select("path", "scan", "digest", "is_list", roots.alias("_roots"))


# Text that is no list must hold exactly one object; two in a row are not JSON. Exploding
# this expression, and not a column of it, keeps Spark from inferring a filter on the
# parsed value and pushing that down to where it would parse everything again.
_WHOLE_ROOTS = "CASE WHEN is_list OR size(_roots) = 1 THEN _roots END"


def repeats(parsed: DataFrame) -> DataFrame:
    """Documents landed more than once within a scan: ``scan``, ``digest`` and ``first``, the least path. Reads digests only."""
    parsed = parsed.filter("head") if "head" in parsed.columns else parsed
    found = parsed.groupBy("scan", "digest").agg(F.min("path").alias("first"), F.count_distinct("path").alias("n"))
    return found.filter("n > 1").drop("n")


def payload_roots(docs: DataFrame) -> DataFrame:
    """One row ``(path, scan, position, payload)`` per payload object; other roots are skipped."""
    return roots_of(parse_documents(docs))


def roots_of(parsed: DataFrame) -> DataFrame:
    """:func:`payload_roots` of parsed documents or of their pieces."""
    if "payload" in parsed.columns:
        return parsed.select("path", "scan", "position", "payload").filter("payload IS NOT NULL")
    exploded = parsed.selectExpr("path", "scan", f"posexplode({_WHOLE_ROOTS}) AS (position, payload)")
    return exploded.filter("payload IS NOT NULL")


def payloads_per_document(docs: DataFrame) -> DataFrame:
    """``(path, is_list, payloads)``: how many usable payload objects each document holds."""
    return parse_documents(docs).selectExpr(
        "path", "is_list", f"coalesce(size(filter({_WHOLE_ROOTS}, r -> r IS NOT NULL)), 0) AS payloads"
    ).withColumn("payloads", F.expr("greatest(payloads, 0)"))


def payload_rejects(docs: DataFrame) -> DataFrame:
    """What flattening cannot use: ``(path, position, reason, n)``.

    Reasons: ``invalid_json``, ``root_not_object``, ``element_not_object``, ``workspace_not_object`` and
    ``item_not_object``; ``n`` counts the rejected elements at that position.
    """
    return rejects_of(parse_documents(docs))


def _found() -> str:
    """The rejects of a parsed document as an array of structs, some of them null."""
    def reject(position: str, reason: str, n: str) -> str:
        return f"struct(CAST({position} AS int) AS position, {reason} AS reason, CAST({n} AS bigint) AS n)"

    shape = "CASE WHEN is_list THEN 'element_not_object' ELSE 'root_not_object' END"
    bad_ws = "size(filter(r.workspaces, w -> w IS NULL))"
    bad_items = (
        "aggregate(r.workspaces, 0, (acc, w) -> acc + greatest(size(filter(w.items, it -> it IS NULL)), 0))"
    )
    per_root = (
        f"array(CASE WHEN r IS NULL THEN {reject('i', shape, '1')} END, "
        f"CASE WHEN {bad_ws} > 0 THEN {reject('i', quoted('workspace_not_object'), bad_ws)} END, "
        f"CASE WHEN {bad_items} > 0 THEN {reject('i', quoted('item_not_object'), bad_items)} END)"
    )
    return (
        f"CASE WHEN ({_WHOLE_ROOTS}) IS NULL THEN array({reject('NULL', quoted('invalid_json'), '1')}) "
        f"ELSE flatten(transform(_roots, (r, i) -> {per_root})) END"
    )


def rejects_of(parsed: DataFrame) -> DataFrame:
    """:func:`payload_rejects` of parsed documents or of their pieces."""
    found = "rejects" if "rejects" in parsed.columns else _found()
    return parsed.selectExpr("path", f"explode({found}) AS r").filter("r IS NOT NULL").select("path", "r.*")


def pieces_of(parsed: DataFrame) -> DataFrame:
    """Parsed documents as narrow rows to land: ``(path, scan, digest, head, rejects, position, payload)``, a payload for each item.

    Readers of columns take thousands of rows at once, which are to be items and not whole documents. A workspace's payloads
    have its own sidecar entry each, the first one its users; a workspace without items has one payload. ``head`` is true for one row
    of a document, which has its rejects, and which is there without any payload too.
    """
    # Outer, so that Spark infers no filter that would parse again; arrays are left behind where they are exploded.
    roots = parsed.selectExpr("path", "scan", "digest", f"filter({_found()}, r -> r IS NOT NULL) AS rejects", f"{_WHOLE_ROOTS} AS roots")
    roots = roots.selectExpr("path", "scan", "digest", "rejects", "posexplode_outer(roots) AS (position, p)")
    listed = "transform(p.workspaces, w -> named_struct('w', w, 'meta', try_element_at(p.workspace_sidecar, w.id)))"
    workspaces = roots.selectExpr("path", "scan", "digest", "rejects", "position", f"posexplode_outer({listed}) AS (_w, z)").selectExpr(
        "path", "scan", "digest", "rejects", "position", "_w", "z.w IS NOT NULL AS _there", "z.meta AS _meta", *[f"z.w.{f} AS _{f}" for f in _WS_FIELDS], "z.w.items AS _items"
    )
    items = workspaces.selectExpr(*[c for c in workspaces.columns if c != "_items"], "posexplode_outer(_items) AS (_i, _item)").selectExpr(
        "*", "coalesce(position, 0) = 0 AND coalesce(_w, 0) = 0 AND coalesce(_i, 0) = 0 AS head"
    )
    fields = [f"'{f}', " + (f"CASE WHEN coalesce(_i, 0) = 0 THEN _{f} END" if f == "users" else f"_{f}") for f in _WS_FIELDS]
    payload = (
        f"named_struct('workspaces', array(named_struct({', '.join(fields)}, 'items', CASE WHEN _item IS NOT NULL THEN array(_item) END)), "
        "'workspace_sidecar', CASE WHEN _meta IS NOT NULL THEN map(_id, _meta) END)"
    )
    return items.selectExpr(
        "path", "scan", "digest", "head", "CASE WHEN head THEN rejects END AS rejects", "position", f"CASE WHEN _there THEN {payload} END AS payload"
    )


def workspace_list(docs: DataFrame) -> DataFrame:
    """Workspace rows of landed list responses.

    A response is a bare list of workspaces or an object with a ``workspaces`` list;
    entries that are not objects are dropped.
    """
    is_list = _first_character(F.col("text")) == "["
    wrapped = F.when(is_list, F.concat(F.lit('{"workspaces":'), F.col("text"), F.lit("}"))).otherwise(F.col("text"))
    ddl = f"workspaces array<{WORKSPACE_DDL}>, _bad string"
    strict = docs.select(wrapped.alias("_text")).select(
        "_text", F.from_json("_text", ddl, _PARSE_OPTIONS).alias("_strict")
    )
    tolerant = F.expr(
        "transform(from_json(_text, 'workspaces array<string>').workspaces, t -> " + _object("t", f"from_json(t, '{WORKSPACE_DDL}')") + ")"
    )
    rows = F.when(F.col("_strict._bad").isNull(), F.col("_strict.workspaces")).otherwise(tolerant)
    ws = strict.select(F.explode(rows).alias("w")).filter(F.col("w").isNotNull())
    return ws.select("w.id", "w.name", "w.type", "w.capacityId", "w.capacityName", "w.isOnDedicatedCapacity")


def raw_items(docs: DataFrame) -> DataFrame:
    """The items of all payloads as the JSON text they landed as, one row (``item``) each."""
    is_list = _first_character(F.col("text")) == "["
    listed = F.when(is_list, F.col("text")).otherwise(F.concat(F.lit("["), F.col("text"), F.lit("]")))
    wrapped = F.concat(F.lit('{"roots":'), listed, F.lit("}"))
    roots = docs.select(F.explode(F.from_json(wrapped, "roots array<string>")["roots"]).alias("r"))
    workspaces = roots.select(F.explode(F.from_json("r", "workspaces array<string>")["workspaces"]).alias("w"))
    items = workspaces.select(F.explode(F.from_json("w", "items array<string>")["items"]).alias("item"))
    return items.filter(F.expr(f"startswith(ltrim({_BLANK}, item), '{{')"))


def legacy_datasource_count(docs: DataFrame) -> DataFrame:
    """Count data sources with connection details in the older ``datasets`` layout.

    Flattening reads ``items`` only; this tells how much a legacy archive would miss.
    """
    ddl = "workspaces array<struct<datasets:array<struct<datasources:array<struct<connectionDetails:variant>>>>>>"
    return (
        docs.select(F.from_json("text", ddl).alias("p"))
        .select(F.explode("p.workspaces").alias("w"))
        .select(F.explode("w.datasets").alias("d"))
        .select(F.explode("d.datasources").alias("s"))
        .filter(F.col("s.connectionDetails").isNotNull())
        .agg(F.count(F.lit(1)).alias("datasources"))
    )


def documents_of_scan(docs: DataFrame, scan_id: str) -> DataFrame:
    """Documents of one finished scan: files named ``<scan_id>.json``."""
    return docs.filter(F.element_at(F.split("path", "/"), -1) == f"{scan_id}.json")
