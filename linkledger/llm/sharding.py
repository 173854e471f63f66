"""Sharding by minimax contiguous partition of ordered atomic groups.

Documents with equal text form one group that is never cut. Groups are ordered by the SHA-256
of their text, so positions don't depend on files or tasks. The smallest shard capacity for
which a greedy pass needs no more than the given shards is found by binary search; the cuts
are then placed within that capacity, each as near to the even division as the capacity
allows.

The driver never holds the groups. It knows the ends of blocks of groups (at first one of
``BLOCKS`` hash ranges each) and runs the greedy pass on these with a lower and an upper bound for
each cut. Where the two disagree, the blocks between them are divided by one more aggregation
of at most about ``ROWS`` rows, until the answer is exact.

Defined cases: null text counts as empty, so null and '' are one group; null doc_ids sort first
within their group; repeated rows keep a slot each; an empty table gives no rows; with fewer
groups than shards some shards stay empty; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkledger.llm.common import landed

#: Hash ranges of the order; a power of 16. Each is numbered by windows of its own.
BINS = 4096
#: Cells into which the rows of one group are spread for numbering.
CELLS = 1024
#: Hash ranges that the driver knows at first; a power of 16 above BINS.
BLOCKS = 65536
#: Most parts into which a block is divided when its inside matters, and most rows of one such step.
PARTS, ROWS = 64, 1 << 17
HEADER_BYTES = 16


class Ends:
    """Known group ends in ascending order, and how many group ends each block between two of them holds (its last one included)."""

    def __init__(self, blocks: list[tuple[int, int]]):
        """blocks: (end, groups) in ascending order of end."""
        self.ends = [0] + [e for e, _ in blocks]
        self.groups = [0] + [n for _, n in blocks]

    @property
    def total(self) -> int:
        return self.ends[-1]

    def at_most(self, t: int) -> tuple[int, int]:
        """Bounds of the largest group end that is <= t; equal when it is known."""
        i = bisect_right(self.ends, t) - 1
        if i + 1 >= len(self.ends) or self.ends[i] == t or self.groups[i + 1] == 1:
            return self.ends[i], self.ends[i]
        return self.ends[i], t

    def at_least(self, t: int) -> tuple[int, int]:
        """Bounds of the smallest group end that is >= t."""
        i = bisect_left(self.ends, t)
        if i == 0 or self.ends[i] == t or self.groups[i] == 1:
            return self.ends[i], self.ends[i]
        return t, self.ends[i]

    def coarse(self, windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The blocks of more than one group that lie in or around the windows."""
        out = set()
        for low, high in windows:
            first = max(1, bisect_left(self.ends, low))
            for i in range(first, min(bisect_left(self.ends, high), len(self.ends) - 1) + 1):
                if self.groups[i] > 1:
                    out.add((self.ends[i - 1], self.ends[i]))
        return sorted(out)

    def divide(self, finer: dict[tuple[int, int], list[tuple[int, int]]]) -> None:
        """Replace blocks by their parts, each (end, groups)."""
        ends, groups = [0], [0]
        for i in range(1, len(self.ends)):
            for e, n in finer.get((self.ends[i - 1], self.ends[i]), [(self.ends[i], self.groups[i])]):
                ends.append(e)
                groups.append(n)
        self.ends, self.groups = ends, groups


def greedy(ends: Ends, capacity: int, shards: int, bound: int) -> list[int]:
    """The cuts of a greedy pass; a lower (0) or upper (1) bound of each."""
    cuts = [0]
    for _ in range(shards):
        cuts.append(ends.at_most(cuts[-1] + capacity)[bound])
    return cuts[1:]


def smallest_capacity(ends: Ends, shards: int, largest: int, refine) -> int:
    """The least capacity for which the greedy pass ends within ``shards``; ``refine(blocks)`` divides blocks of ``ends``."""
    while True:
        found = []
        for bound in (1, 0):  # least capacity that may fit, then the least that surely fits
            low, high = found[0] if found else max(largest, -(-ends.total // shards)), ends.total
            while low < high:
                middle = (low + high) // 2
                if greedy(ends, middle, shards, bound)[-1] >= ends.total:
                    high = middle
                else:
                    low = middle + 1
            found.append(low)
        if found[0] == found[1]:
            return found[0]
        refine(ends.coarse(list(zip(greedy(ends, found[0], shards, 0), greedy(ends, found[1], shards, 1), strict=True))))


def cuts_within(ends: Ends, capacity: int, shards: int, refine) -> list[int]:
    """``shards - 1`` cuts at group ends: no shard above the capacity, each cut nearest to the even division."""
    while True:
        low = high = ends.total
        least, windows = [low], []
        for _ in range(shards - 1):
            low, high = ends.at_least(max(0, low - capacity))[0], ends.at_least(max(0, high - capacity))[1]
            least.append(low)
            if low != high:
                windows.append((low, high))
        least.reverse()  # least[j]: what the first j + 1 shards have to hold at least
        cuts, last = [], 0
        for j in range(shards - 1):
            even = ends.total * (j + 1) // shards
            below, above, most = ends.at_most(even), ends.at_least(even), ends.at_most(last + capacity)
            windows += [w for w in (below, above, most) if w[0] != w[1]]
            cut = below[0] if even - below[0] <= above[1] - even else above[1]
            last = min(max(cut, least[j], last), most[0])
            cuts.append(last)
        if not windows:
            return cuts
        refine(ends.coarse(windows))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document; slots count from 0 in each shard without gaps."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = landed(
        docs.select(
            F.col(id_col).alias("doc_id"), (F.octet_length(text) + HEADER_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("digest"),
            F.pmod(F.xxhash64(id_col), F.lit(CELLS)).cast("int").alias("cell"),
        ),
        "sizes",
    )
    digits = len(f"{BINS - 1:x}")
    in_order = W.partitionBy("bin").orderBy("digest", "cell")
    cells = landed(
        rows.groupBy("digest", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        .withColumn("bin", F.conv(F.substring("digest", 1, digits), 16, 10).cast("int"))
        .select(
            "bin", "digest", "cell", "n", "bytes",
            F.sum("bytes").over(W.partitionBy("bin").orderBy("digest")).alias("end"),  # with the whole group
            (F.sum("n").over(in_order) - F.col("n")).alias("first"),
            F.coalesce(F.lag("digest").over(in_order) != F.col("digest"), F.lit(True)).alias("head"),
            F.sum("bytes").over(W.partitionBy("bin", "digest")).alias("group_bytes"),
        ),
        "cells",
    )
    more = len(f"{BLOCKS - 1:x}") - digits
    fine = sorted(
        cells.groupBy("bin", F.substring("digest", digits + 1, more).alias("fine")).agg(
            F.sum("bytes"), F.sum("n"), F.sum(F.col("head").cast("int")), F.max("group_bytes")
        ).collect()
    )  # at most BLOCKS rows
    blocks, offsets, done_bytes, done_rows = [], [], 0, 0
    for b, _, size, n, groups, _ in fine:
        if not offsets or offsets[-1][0] != b:
            offsets.append((b, done_bytes, done_rows))
        done_bytes, done_rows = done_bytes + size, done_rows + n
        blocks.append((done_bytes, groups))
    offsets_df = spark.createDataFrame(offsets, "bin int, bytes_before long, rows_before long")
    placed = cells.join(F.broadcast(offsets_df), "bin").select(
        "bin", "digest", "cell", "head", (F.col("end") + F.col("bytes_before")).alias("end"),
        (F.col("first") + F.col("rows_before")).alias("first"),
    )
    starts, ends = [x[1] for x in offsets], Ends(blocks)

    def refine(wanted: list[tuple[int, int]]) -> None:
        asked = spark.createDataFrame([(offsets[bisect_right(starts, a) - 1][0], a, b) for a, b in wanted], "bin int, a long, b long")
        part = F.expr(f"(end - a - 1) * {max(2, min(PARTS, ROWS // len(wanted)))} div (b - a)")
        heads = placed.where("head").select("bin", "end").alias("p")
        found = (
            heads.join(F.broadcast(asked), (heads["bin"] == asked["bin"]) & (heads["end"] > asked["a"]) & (heads["end"] <= asked["b"]))
            .groupBy("a", "b", part.alias("part")).agg(F.min("end"), F.max("end"), F.count("*")).collect()
        )
        finer: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for a, b, _, first_end, last_end, n in sorted(found):
            finer.setdefault((a, b), []).append((first_end, 1))  # alone, so that every step gets on
            if n > 1:
                finer[(a, b)].append((last_end, n - 1))
        ends.divide(finer)

    largest = max((x[5] for x in fine), default=0)
    cuts = cuts_within(ends, smallest_capacity(ends, shards, largest, refine), shards, refine) if fine else []
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("end") > F.lit(cut)).cast("int")
    placed = placed.withColumn("shard", shard)
    base = {s: n for s, n in placed.groupBy("shard").agg(F.min("first")).collect()}  # one row a shard
    first_row = F.lit(0).cast("long")
    for s, n in base.items():
        first_row = F.when(F.col("shard") == s, F.lit(n).cast("long")).otherwise(first_row)
    by_cell = W.partitionBy("digest", "cell").orderBy("doc_id")
    return rows.join(placed.select("digest", "cell", "shard", (F.col("first") - first_row).alias("before")), ["digest", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.row_number().over(by_cell) - 1).alias("slot"),
    )
