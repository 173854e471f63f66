"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits. Level 0 has the low chunk of every id, and a bitmap that
says for which ids another chunk follows; level 1 has these chunks and a bitmap of its own,
and so on. A rank directory (ones before each 512 bits) finds the place of a chunk in the
next level, so any token of any segment is read without decoding others.

A file is a table of segments in the shared folder, written and committed by Spark: part and seq
(their order), the tokens of the part before the segment, doc_ids and lengths of its documents, and
the levels. Documents are in ascending doc_id over the parts (nulls first, equal ids by a
hash of the text); every document ends with the given end id.

Defined cases: null text counts as empty and has only the end id; repeated rows are documents of their own; an
empty table gives an empty file; extra columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkledger.llm.pretokens import WITHOUT_SPACE, Encoder, Remembered
from linkledger.sinks.scratch import scratch_dir

#: A segment is closed once it has so many tokens.
SEGMENT_TOKENS = 1 << 18
RANK_BITS = 512
#: Entries of a generation of a worker's cache, of which there are two: some 140 MB. Fewer cost time, not results.
CACHE = 350_000
END = 2
SEGMENTS = (
    "part int, seq int, before long, n_tokens long, doc_ids array<bigint>, lengths array<int>, "
    "levels array<struct<chunks: binary, more: binary, ranks: binary>>"
)
_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int32())),
    ("levels", pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))),
])


def encode(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of an array of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunks, rest = (rest & 0xFF).astype(np.uint8), rest >> np.uint32(8)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, dtype=np.uint32)
        padded[: len(more)] = more
        ones = padded.reshape(-1, RANK_BITS).sum(axis=1, dtype=np.uint32)
        ranks = np.cumsum(ones, dtype=np.uint32) - ones
        levels.append({"chunks": chunks.tobytes(), "more": bits.tobytes(), "ranks": ranks.astype("<u4").tobytes()})
        if not more.any():
            return levels
        rest = rest[more]


def decode(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    out = np.frombuffer(levels[0]["chunks"], dtype=np.uint8).astype(np.uint32)
    at = np.arange(len(out))
    for k in range(1, len(levels)):
        more = np.unpackbits(np.frombuffer(levels[k - 1]["more"], dtype=np.uint8), count=len(at), bitorder="little").astype(bool)
        at = at[more]
        out[at] |= np.frombuffer(levels[k]["chunks"], dtype=np.uint8).astype(np.uint32) << np.uint32(8 * k)
    return out


def token_at(levels: list[dict[str, bytes]], i: int) -> int:
    """One id, from one chunk a level, one bit, one rank and at most 64 bytes of bitmap."""
    value = 0
    for k, level in enumerate(levels):
        value |= level["chunks"][i] << (8 * k)
        if not level["more"][i >> 3] >> (i & 7) & 1:
            break
        block = i // RANK_BITS
        rank = int.from_bytes(level["ranks"][4 * block : 4 * block + 4], "little")
        bits = int.from_bytes(level["more"][block * RANK_BITS // 8 : (i >> 3) + 1], "little")
        i = rank + (bits & ((1 << (i % RANK_BITS)) - 1)).bit_count()
    return value


class _Ids:
    """Ids of a text as bytes; those of its pieces are remembered."""

    def __init__(self, path: str, cache: int = CACHE):
        self.encoder, self.known = Encoder(path, lower=True), Remembered(self._encoded, cache)

    def _encoded(self, piece: str) -> bytes:
        return array("I", self.encoder.ids(piece)).tobytes()

    def ids(self, text: str) -> bytes:
        # As the library does, but before the look-ups, of which fewer then miss; it looks for special strings first.
        if text.isascii() and "<|" not in text:
            text = text.lower()
        return b"".join(map(self.known.__getitem__, WITHOUT_SPACE.findall(text)))


_WORKER: dict[tuple[str, int], _Ids] = {}


def _segments(path: str, end: int, cache: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, cache) not in _WORKER:
            _WORKER.clear()
            _WORKER[(path, cache)] = _Ids(path, cache)
        encoded, last = _WORKER[(path, cache)].ids, np.array([end], dtype="<u4").tobytes()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        lengths: list[int] = []
        held: list[bytes] = []
        tokens = 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            row = {"part": part, "seq": seq, "before": before, "n_tokens": tokens, "doc_ids": doc_ids, "lengths": lengths, "levels": encode(ids)}
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoded(text.as_py() or "") + last
                held.append(ids)
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                tokens += len(ids) // 4
                if tokens >= SEGMENT_TOKENS:
                    yield segment()
                    seq, before = seq + 1, before + tokens
                    doc_ids, lengths, held, tokens = [], [], [], 0
        if held:
            yield segment()
        if cache < CACHE:  # short of memory: no pieces are left to the worker's next task; the library is, as another one for every task adds up
            _WORKER[(path, cache)].known.forget()

    return run


def write_tokens(
    docs: DataFrame, to: str, path: str | None = None, end: int = END, cache: int = CACHE, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the documents' ids as a file of segments."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    tie = F.xxhash64(text_col).alias("tie")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), tie)
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(_segments(path, end, cache), SEGMENTS).write.option("compression", "zstd").parquet(to)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode(row["levels"]).astype("<u4")
            lengths = np.array(row["lengths"], dtype=np.int64)
            stop = np.cumsum(lengths)
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((stop - lengths).tolist(), stop.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + stop - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def with_starts(spark: SparkSession, to: str) -> DataFrame:
    """The segments with ``before`` counted over the whole file."""
    segments = spark.read.schema(SEGMENTS).parquet(to)
    parts = sorted(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # one row a part
    offsets, done = [], 0
    for part, n in parts:
        offsets.append((part, done))
        done += n
    offset = spark.createDataFrame(offsets, "part int, parts_before long")
    return segments.join(F.broadcast(offset), "part").withColumn("before", F.col("before") + F.col("parts_before")).drop("parts_before")


def read_documents(spark: SparkSession, to: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of a file."""
    rows = with_starts(spark, to).select("doc_ids", "lengths", "levels", "before")
    return rows.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_at(spark: SparkSession, to: str, places: DataFrame) -> DataFrame:
    """(place, token) of the given places (column ``place``, counted over the whole file), without decoding segments."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["place"] for r in rows], pa.int64()), pa.array([token_at(r["levels"], r["place"] - r["before"]) for r in rows], pa.int64())],
                ["place", "token"],
            )

    segments, bucket = with_starts(spark, to).select("before", "n_tokens", "levels"), SEGMENT_TOKENS
    covered = segments.withColumn("bucket", F.explode(F.sequence(F.expr(f"before div {bucket}"), F.expr(f"(before + n_tokens - 1) div {bucket}"))))
    asked = places.select("place", F.expr(f"place div {bucket}").alias("bucket"))
    met = asked.join(covered, "bucket").where("place >= before AND place < before + n_tokens").select("place", "before", "levels")
    return met.mapInArrow(pick, "place long, token long")


def written_and_read(docs: DataFrame, path: str | None = None, end: int = END, cache: int = CACHE) -> DataFrame:
    """Write all documents to a new file in the shared folder and read them back from it."""
    to = scratch_dir(docs.sparkSession, "llm-tokens")
    write_tokens(docs, to, path, end, cache)
    return read_documents(docs.sparkSession, to)
