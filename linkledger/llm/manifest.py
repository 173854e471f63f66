"""Merkle manifest of a dataset: leaf coordinates by bitmap rank, levels reduced as keyed slot arrays.

A leaf's place in its source is a rank: how many ids of the source are less. The ids of each source are a
compressed bitmap, only the 64-bit words that hold an id, merged by ``bit_or`` before and after the shuffle. A
directory of popcounts, by blocks of 4,096 words (and blocks of these, as far as the ids reach), gives the rows before a
word; a row's slot is that and the ones below its bit. No ids are sorted and no source is gathered.

Slots then key the levels: 4,096 neighbouring slots are one array, filled by place, and three levels of 16 are
hashed from it at a time. What these give are the slots of the next array, until one node a source is left; the
subroots make a tree of their own. On the way back each array passes the siblings' texts of its own node to its members,
so a proof is put together where its leaf is and never shuffled.

Defined cases: a null doc_id comes before all others of its source; rows with equal ids (or without) are in order of
their leaf digests, wholly equal rows in order of reading; a null source is a group of its own and comes
first; other nulls are ``-`` in the leaf; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkledger.llm.common import ascii_lower, landed

FAN = 16
#: Levels that are hashed from one array, and its slots.
STEP = 3
SLOTS = FAN**STEP
#: Words of a block of the directory, as a power of two.
BLOCK = 12
#: The word of rows without an id: less than that of any.
NO_ID = -(1 << 57) - 1
_PATH = "array<struct<left: string, right: string>>"
_PATHS = f"g string, slot long, path {_PATH}"


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of the fields, each ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _running(df: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over rows of the same ``by`` with a lesser ``order``."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))


def _before(rows: DataFrame, keys: list[str], start: int) -> DataFrame:
    """Counts of the distinct ``keys`` with ``before``: the rows that share ``keys[:start]`` and come before, key by key."""
    cells = rows.groupBy(*keys).agg(F.sum("n").alias("n"))
    out = cells.withColumn("before", F.lit(0).cast("long"))
    for i in range(start, len(keys)):
        level = _running(cells.groupBy(*keys[: i + 1]).agg(F.sum("n").alias("n")), keys[:i], keys[i], "n", "_less").drop("n")
        out = out.join(level, keys[: i + 1]).withColumn("before", F.col("before") + F.col("_less")).drop("_less")
    return out


def directory(rows: DataFrame) -> DataFrame:
    """src, w, bits, n and before (rows of the source in words before) of every word that holds an id."""
    words = landed(rows.groupBy("src", "w").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.count("*").alias("n")), "words")
    low, high = words.agg(F.min("w"), F.max("w")).first()
    shifts = [0]
    while low is not None and (high >> shifts[-1]) - (low >> shifts[-1]) >= 1 << BLOCK:
        shifts.append(shifts[-1] + BLOCK)
    keys = ["src", *[f"w{s}" for s in reversed(shifts)]]
    placed = words
    for s in shifts:
        placed = placed.withColumn(f"w{s}", F.shiftright("w", s))
    return words.join(_before(placed, keys, 1).select("src", F.col("w0").alias("w"), "before"), ["src", "w"])


def _slots(rows: DataFrame) -> DataFrame:
    """Rows with ``slot``, the rank in their source."""
    words = landed(directory(rows), "directory")
    once = F.expr("n = bit_count(bits)")
    found = rows.join(words, ["src", "w"])
    plain = found.where(once).withColumn("slot", F.expr("before + bit_count(bits & ~shiftleft(-1L, bit))"))
    columns = [*rows.columns, "slot"]
    if words.where(~once).isEmpty():
        return plain.select(columns)
    again = found.where(~once).select(*rows.columns, F.col("before").alias("word_before"), F.lit(1).alias("n"))
    again = again.withColumn("some", F.substring(F.hex("leaf"), 1, 3)).withColumn("part", F.shiftright("rid", 33))
    keys = ["src", "w", "bit", "some", "leaf", "part"]
    ahead = _before(again, keys, 2).select(*keys, "before")
    number = F.row_number().over(W.partitionBy(*keys).orderBy("rid"))
    again = again.withColumn("number", number).join(ahead, keys).withColumn("slot", F.col("word_before") + F.col("before") + F.col("number") - 1)
    return plain.select(columns).unionByName(again.select(columns))


def _depth(n: str) -> Column:
    return sum((F.col(n) > FAN**i).cast("int") for i in range(15))


def _levels(digests: list[str], times: int) -> list[list[str]]:
    """The digests and what ``times`` further levels make of them."""
    out = [digests]
    for _ in range(times):
        out.append([_digest("".join(out[-1][i : i + FAN])) for i in range(0, len(out[-1]), FAN)])
    return out


def _siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Of member ``i`` and the nodes above it, the digests left and right in their runs."""
    out = []
    for level in levels[:-1]:
        start = i - i % FAN
        out.append(("".join(level[start:i]), "".join(level[i + 1 : start + FAN])))
        i //= FAN
    return out


def _array(members: list[dict]) -> list[dict]:
    out: list = [None] * len(members)
    for m in members:
        out[m["place"]] = m
    return out


def _times(depth: int, base: int) -> int:
    return min(STEP, depth - base)


def _nodes(base: int):
    """Of each array its node, as a slot of the next ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            tops = [_levels([m["digest"].hex() for m in _array(r["members"])], _times(r["depth"], base))[-1][0] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["g"] for r in rows], pa.string()), pa.array([r["depth"] for r in rows], pa.int32()),
                 pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([bytes.fromhex(t) for t in tops], pa.binary())],
                ["g", "depth", "slot", "digest"],
            )

    return run


def _paths(base: int):
    """Of each member of each array the siblings up to the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for batch in batches:
            for r in batch.to_pylist():
                digests = [m["digest"].hex() for m in _array(r["members"])]
                levels = _levels(digests, _times(r["depth"], base))
                paths = [[{"left": a, "right": b} for a, b in _siblings(levels, i)] + r["path"] for i in range(len(digests))]
                first = r["chunk"] * SLOTS
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["g"]] * len(paths), pa.string()), pa.array(range(first, first + len(paths)), pa.int64()), pa.array(paths, kind)],
                    ["g", "slot", "path"],
                )

    return run


def _arrays(nodes: DataFrame, *more: str) -> DataFrame:
    member = F.struct((F.col("slot") % SLOTS).cast("int").alias("place"), "digest", *more)
    grouped = nodes.groupBy("g", "depth", F.expr(f"slot div {SLOTS}").alias("chunk"))
    return landed(grouped.agg(F.collect_list(member).alias("members")), "slot-arrays")


def _tree(nodes: DataFrame, deepest: int, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of all steps and the root digest of every group; nodes: g, depth, slot, digest and, in the first arrays, more."""
    steps = [_arrays(nodes, *more)]
    roots = None
    while True:
        base = STEP * (len(steps) - 1)
        made = steps[-1].mapInArrow(_nodes(base), "g string, depth int, slot long, digest binary")
        ended = made.where(F.col("depth") <= base + STEP).select("g", "digest")
        roots = ended if roots is None else roots.unionByName(ended)
        if deepest <= base + STEP:
            return steps, roots
        steps.append(_arrays(made.where(F.col("depth") > base + STEP)))


def _down(steps: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The first arrays with the ``path`` of their own node; ``paths``: g and path of every group's root."""
    inner = None
    for k in range(len(steps) - 1, -1, -1):
        # A group ends at the last step its depth needs; there its one array has the root's own path.
        top = F.col("depth") <= STEP * (k + 1)
        found = steps[k].where(top).join(paths, "g")
        if inner is not None:
            found = found.unionByName(steps[k].where(~top).join(inner, ["g", "chunk"]))
        if k:
            below = found.select("g", "depth", "chunk", "members", "path").mapInArrow(_paths(STEP * k), _PATHS)
            inner = below.withColumnRenamed("slot", "chunk")
    return found


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            members = _array(r["members"])
            leaves = [m["digest"].hex() for m in members]
            levels, root = _levels(leaves, _times(r["depth"], 0)), r["root"].hex()
            above = [(p["left"], p["right"]) for p in r["path"]]
            proofs, folded = [], []
            for i, m in enumerate(members):
                path = _siblings(levels, i) + above
                proofs.append(_digest("".join(a + b for a, b in path)))
                node = m["tampered"].hex() if m["tampered"] is not None else leaves[i]
                for a, b in path:
                    node = _digest(a + node + b)
                folded.append(node)
            n = len(members)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m["doc_id"] for m in members], pa.int64()), pa.array(leaves), pa.array([r["subroot"].hex()] * n),
                 pa.array([root] * n), pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded])],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )


def _in_order(groups: DataFrame) -> DataFrame:
    """Groups with their rank ``slot`` by name: ranges, and a running count over the ranges."""
    ranges = landed(groups.repartitionByRange("g").withColumn("p", F.spark_partition_id()), "ranges")
    ahead = _running(ranges.groupBy("p").agg(F.count("*").alias("n")), [], "p", "n", "before").select("p", "before")
    number = F.row_number().over(W.partitionBy("p").orderBy("g"))
    return ranges.withColumn("number", number).join(ahead, "p").withColumn("slot", F.col("before") + F.col("number") - 1).drop("p", "number", "before")


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """A row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` is a text to put in place of a row's own when the proof is folded; null leaves the row alone.
    """
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    changed = F.lit(None).cast("string") if tampered is None else tampered
    rows = landed(
        docs.select(
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("src"), F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.shiftright(F.col("doc_id").cast("long"), 6), F.lit(NO_ID)).alias("w"),
            F.coalesce(F.col("doc_id").cast("long").bitwiseAND(63), F.lit(0)).cast("int").alias("bit"),
            F.unhex(leaf_digest([*fields, F.col("text")])).alias("leaf"),
            F.when(changed.isNotNull(), F.unhex(leaf_digest([*fields, changed]))).alias("tampered"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "leaves",
    )
    sizes = landed(rows.groupBy(F.col("src").alias("g")).agg(F.count("*").alias("size")).withColumn("depth", _depth("size")), "sources")
    deepest, sources = sizes.agg(F.max("depth"), F.count("*")).first()
    leaves = _slots(rows).select(F.col("src").alias("g"), "slot", F.col("leaf").alias("digest"), "doc_id", "tampered")
    steps, subroots = _tree(leaves.join(sizes.select("g", "depth"), "g"), deepest or 0, "doc_id", "tampered")
    subroots = landed(subroots.withColumnRenamed("digest", "subroot"), "subroots")
    ordered = landed(_in_order(subroots), "ordered")
    depth = sum(sources > FAN**i for i in range(15))
    top = ordered.select(F.lit("").alias("g"), F.lit(depth).cast("int").alias("depth"), "slot", F.col("subroot").alias("digest"))
    top_steps, roots = _tree(top, depth)
    ends = roots.select("g", F.expr(f"CAST(array() AS {_PATH})").alias("path"))
    first = _down(top_steps, ends).select("g", "depth", "chunk", "members", "path").mapInArrow(_paths(0), _PATHS).select("slot", "path")
    root = roots.first()  # of one group, so one row
    known = ordered.join(first, "slot").select("g", "subroot", F.lit(root and root.digest).cast("binary").alias("root"), "path")
    known = landed(known, "source-paths")
    below = _down(steps, known.select("g", "path")).join(known.select("g", "subroot", "root"), "g")
    return below.select("depth", "members", "path", "subroot", "root").mapInArrow(
        _proofs, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


def lower_cased(docs: DataFrame) -> Column:
    """Text with A-Z in lower case where 5 divides the checksum of the decimal doc_id; null for all other rows and texts."""
    return F.when((F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & F.col("text").isNotNull(), ascii_lower(F.col("text")))
