"""Mixing sources to target weights, by blocks of fixed length.

The words of a source's documents, in a pseudorandom but fixed order, form one stream that is
cut into blocks of ``BLOCK_WORDS``. Each source has a number of slots in the mix, from its
target. Source counts of each output shard are multinomial draws, conditioned on the sources'
totals (the multivariate hypergeometric law), so each target is met and not only on average.
Slots go through a pseudorandom permutation of the source's block numbers, another one for
each time the source is gone through, and the blocks are joined by number. The source's last block, which can be
shorter, ends each time, and its last slot takes only the words that are missing: the mix has the target's words, rounded.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share ``SHARE`` of all
words; a target stops at ``AT_MOST`` times its source, the excess going to the others by
weight. No block is used more than ``AT_MOST`` times, hence no document either.

The driver holds one number for each source and shard, never anything by document.

Defined cases: null text has no words, and such documents take none; null is a source of its
own; repeated rows are documents of their own; an empty table gives no rows; extra columns
are passed on by ``mixed_documents`` and otherwise not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from linkledger.llm.common import landed, unused

BLOCK_WORDS = 256
SHARDS = 64
WEIGHTS = (5, 2, 1)
SHARE = 1.5
AT_MOST = 2
SEED = 20240601
#: Parts into which a source's documents are spread for numbering their words.
PARTS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int]) -> list[float]:
    """Words to take of each source; ``sizes`` in the order of the weights."""
    size = np.array(sizes, dtype=float)
    weight = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))], dtype=float)
    out, open_, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), SHARE * size.sum()
    while open_.any():
        share = np.where(open_, left * weight / weight[open_].sum(), 0.0)
        full = open_ & (share >= AT_MOST * size)
        if not full.any():
            out[open_] = share[open_]
            break
        out[full] = AT_MOST * size[full]
        left -= out[full].sum()
        open_ &= ~full
    return out.tolist()


def shard_counts(slots: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Slots of each source (column) in each shard (row)."""
    rng, left = np.random.default_rng(seed), slots.astype(np.int64).copy()
    out = np.zeros((shards, len(slots)), dtype=np.int64)
    for k in range(shards):
        n = int(left.sum()) // (shards - k)
        out[k] = left if k == shards - 1 else _draw(rng, left, n)
        left -= out[k]
    return out


def _draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """Multinomial counts conditioned on what is left: binomial shares source by source, kept possible."""
    out, rest, need = np.zeros_like(left), int(left.sum()), n
    for i, have in enumerate(left.tolist()):
        rest_after = rest - have
        if need and have:
            if rest < 10**9:
                got = int(rng.hypergeometric(have, rest_after, need)) if rest_after else need
            else:  # beyond the generator's range the binomial is the same to nine digits
                got = int(rng.binomial(need, have / rest))
            out[i] = min(have, max(got, need - rest_after))
            need -= int(out[i])
        rest = rest_after
    return out


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a pseudorandom permutation of 0..n-1 takes i: four Feistel rounds, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.astype(np.uint64), np.arange(len(i))
    while len(todo):
        h, m, x = half[todo], mask[todo], out[todo]
        a, b = x >> h, x & m
        for r in range(4):
            f = (b + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15) + key[todo]
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((f ^ (f >> np.uint64(32))) & m)
        out[todo] = (a << h) | b
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


class Plan:
    """What the driver knows of a mix: sources in order, their sizes, targets, blocks and slots."""

    def __init__(self, sizes: list[tuple[str | None, int]], block_words: int, shards: int, seed: int):
        self.sources = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
        size = [n for _, n in self.sources]
        self.targets = targets(size)
        self.blocks = np.array([-(-n // block_words) for n in size], dtype=np.int64)
        #: Slots of each source, and the words that its last one takes (0: all of its block).
        self.slots, self.last_words = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
        for i, (t, b, n) in enumerate(zip(self.targets, self.blocks.tolist(), size, strict=True)):
            times, rest = divmod(min(int(t + 0.5), AT_MOST * n), n) if n else (0, 0)
            self.slots[i] = times * b + -(-rest // block_words)
            self.last_words[i] = rest % block_words
        self.counts = shard_counts(self.slots, shards, seed)
        self.seed = seed


def _ordered(docs: DataFrame, plan_sources: DataFrame, block_words: int) -> DataFrame:
    """rows with their source's rank and the place of their first word in the source's stream."""
    rows = docs.join(plan_sources, docs["source"].eqNullSafe(plan_sources["named"])).withColumn(
        "part", F.pmod("order_key", F.lit(PARTS)).cast("int")
    )
    parts = rows.groupBy("rank", "part").agg(F.sum("size").alias("words"))
    before = parts.select("rank", "part", (F.sum("words").over(W.partitionBy("rank").orderBy("part")) - F.col("words")).alias("before"))
    inside = W.partitionBy("rank", "part").orderBy("order_key", "doc_id", "rid")
    return rows.withColumn("inside", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).join(
        before, ["rank", "part"]
    ).withColumn("first", F.col("before") + F.col("inside"))


def _pieces(rows: DataFrame, block_words: int) -> DataFrame:
    """A row for each document and block that share words; ``at``: where in the block they begin."""
    low, high = F.expr(f"first div {block_words}"), F.expr(f"(first + size - 1) div {block_words}")
    start = F.greatest(F.col("first"), F.col("block") * block_words)
    stop = F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * block_words)
    return rows.where("size > 0").select("rank", "rid", "doc_id", "first", "size", F.explode(F.sequence(low, high)).alias("block")).select(
        "rank", "block", "rid", "doc_id", (start - F.col("first")).alias("from_word"), (stop - start).alias("words"),
        (start - F.col("block") * block_words).alias("at"),
    )


def _uses(pieces: DataFrame, slots: DataFrame) -> DataFrame:
    """The pieces with how many ``times`` the mix takes them; one that the end of a source's last slot cuts comes as two."""
    per_block = slots.groupBy("rank", "block").agg(F.count_if(F.col("some") == 0).alias("whole"), F.max("some").alias("some"))
    joined = pieces.join(per_block, ["rank", "block"], "left").select(
        "rid", "from_word", "words", F.coalesce("whole", F.lit(0)).alias("whole"),
        F.greatest(F.lit(0), F.least(F.col("words"), F.coalesce("some", F.lit(0)) - F.col("at"))).alias("head"),
    )
    parts = F.expr("array(struct(from_word AS f, head AS w, whole + 1 AS t), struct(from_word + head AS f, words - head AS w, whole AS t))")
    return joined.select("rid", F.explode(parts).alias("p")).where("p.w > 0").select(
        "rid", F.col("p.f").alias("from_word"), F.col("p.w").alias("words"), F.col("p.t").alias("times")
    )


def _slots(spark, plan: Plan) -> DataFrame:
    """A row for each slot of the mix: shard, place in the shard, source's rank, block; ``some``: the words it takes if not all."""
    counts, blocks, seed, all_slots, last_words = plan.counts, plan.blocks, plan.seed, plan.slots, plan.last_words
    before = np.cumsum(counts, axis=0) - counts  # slots of the source in earlier shards
    starts = np.cumsum(counts.ravel()) - counts.ravel()
    shard_start = np.cumsum(counts.sum(axis=1)) - counts.sum(axis=1)

    @F.arrow_udf("struct<shard:int,place:bigint,rank:int,block:bigint,some:bigint>")
    def slot(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        n_sources = counts.shape[1]
        for batch in ids:
            g = batch.to_numpy(zero_copy_only=False)
            cell = np.searchsorted(starts, g, side="right") - 1
            shard, rank = cell // n_sources, cell % n_sources
            j = before[shard, rank] + g - starts[cell]
            n = blocks[rank]
            key = (rank.astype(np.uint64) * np.uint64(AT_MOST + 1) + (j // n).astype(np.uint64)) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed)
            ends = j % n == n - 1  # the last block stays at the end
            block = np.where(ends, n - 1, permuted(np.where(ends, 0, j % n), np.maximum(n - 1, 1), key))
            yield pa.StructArray.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(g - shard_start[shard], pa.int64()), pa.array(rank, pa.int32()),
                 pa.array(block, pa.int64()), pa.array(np.where(j == all_slots[rank] - 1, last_words[rank], 0), pa.int64())],
                ["shard", "place", "rank", "block", "some"],
            )

    return spark.range(int(counts.sum())).select(slot("id").alias("s")).select("s.*")


def _planned(docs: DataFrame, block_words: int, shards: int, seed: int):
    """Rows with a number, size and order; the plan; pieces and slots."""
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.sum("size").cast("long")).collect()  # one row a source
    plan = Plan([(s, n or 0) for s, n in sizes], block_words, shards, seed)
    named = spark.createDataFrame(
        [(s, i, n, t) for i, ((s, n), t) in enumerate(zip(plan.sources, plan.targets, strict=True))],
        "named string, rank int, source_size long, target double",
    )
    rows = _ordered(docs, named, block_words)
    return plan, rows


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("order_key"), F.monotonically_increasing_id().alias("rid"),
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    plan, rows = _planned(landed(_sized(docs, seed), "words"), block_words, shards, seed)
    uses = _uses(_pieces(rows, block_words), _slots(docs.sparkSession, plan))
    taken = uses.groupBy("rid").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return rows.join(taken, "rid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself: shard, place, source's rank, block and the pieces of documents in it (doc_id, from_word, words)."""
    plan, rows = _planned(landed(_sized(docs, seed), "words"), block_words, shards, seed)
    met = _slots(docs.sparkSession, plan).join(_pieces(rows, block_words), ["rank", "block"])
    words = F.when(F.col("some") > 0, F.least(F.col("words"), F.col("some") - F.col("at"))).otherwise(F.col("words"))
    return met.withColumn("words", words).where("words > 0").drop("some", "at")


@F.arrow_udf(T.ArrayType(T.StringType()))
def _cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
    """The pieces of each text that begin at the given words and run to the next given word, or the end of the text."""
    import re

    word, out = re.compile(r"[^\x20\x09-\x0D]+"), []
    for text, firsts in zip(texts.to_pylist(), starts.to_pylist(), strict=True):
        at = [m.start() for m in word.finditer(text)]
        edges = [0 if f == 0 else at[f] for f in firsts] + [len(text)]
        out.append([text[a:b] for a, b in zip(edges, edges[1:], strict=False)])
    return pa.array(out, pa.list_(pa.string()))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row with the columns of ``docs`` for each use of a piece, ``text`` and ``n_chars`` being the piece's."""
    rid, pieces_of = unused(docs, "rid"), unused(docs, "pieces")
    kept = landed(docs.withColumn(rid, F.monotonically_increasing_id()), "mixed-docs")
    sized = kept.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("order_key"), F.col(rid).alias("rid"),
    )
    plan, rows = _planned(landed(sized, "words"), block_words, shards, seed)
    uses = _uses(_pieces(rows, block_words), _slots(docs.sparkSession, plan))
    pieces = uses.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("from_word", "times"))).alias("pieces"))  # of one document
    pieces = pieces.select(F.col("rid").alias(rid), F.col("pieces").alias(pieces_of))
    cut = kept.join(pieces, rid).withColumn(
        pieces_of, F.arrays_zip(_cut("text", F.col(f"{pieces_of}.from_word")).alias("t"), F.col(f"{pieces_of}.times").alias("n"))
    )
    named = [f for f in docs.columns]
    one = unused(docs, "piece")
    out = cut.withColumn(one, F.explode(pieces_of)).withColumn(one, F.explode(F.array_repeat(F.col(f"{one}.t"), F.col(f"{one}.n").cast("int"))))
    return out.select(*[
        F.col(one).alias(c) if c == "text" else F.length(one).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
        for c in named
    ])
