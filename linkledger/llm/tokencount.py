"""Token counts by a map-side two-tier lookup.

First tier: a compact table of the lengths of frequent pieces (see ``pretokens``), learnt from
at most about ``SAMPLE`` documents, at most ``TABLE`` entries, broadcast. It decides only how fast
a length is found, never the length. Second tier: pieces that the table misses are encoded by
the library once and kept in the worker's cache, of two generations of ``CACHE`` entries.
Texts stay where they are read; no piece of the documents is ever shuffled.

Special strings inside texts count as the library counts them by default.

Defined cases: null text counts as empty, with no bytes and no tokens; repeated rows are counted
each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.llm.pretokens import LONGEST_KEPT, WITH_SPACE, Encoder, Remembered

#: Documents from which the frequent pieces are learnt, entries of their table, entries of a generation of a worker's cache.
SAMPLE, TABLE, CACHE = 5_000, 32_768, 250_000
OVER = 512


class _Lengths(dict):
    """The broadcast table; what it misses is looked up in the worker's cache or encoded."""

    def __init__(self, table: dict[str, int], path: str):
        super().__init__(table)
        self.encoder = Encoder(path, lower=False)
        self.cache = Remembered(lambda piece: len(self.encoder.ids(piece)), CACHE)
        library = self.encoder.library
        self.specials = [t.content for t in library.get_added_tokens_decoder().values() if t.special]

    def __missing__(self, piece: str) -> int:
        return self.cache[piece]

    def count(self, text: str) -> int:
        parts, n = [text], 0
        for special in self.specials:  # white space before one is a run of its own
            parts = [x for p in parts for x in p.split(special)]
        n = sum(text.count(s) for s in self.specials)
        for p in parts:
            n += sum(map(self.__getitem__, WITH_SPACE.findall(p)))
        return n


_WORKER: dict[tuple, _Lengths] = {}


def _counter(table, path: str):
    @F.arrow_udf("bigint")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key = (table.id if hasattr(table, "id") else id(table), path)
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = _Lengths(table.value, path)
        count = _WORKER[key].count
        for texts in batches:
            yield pa.array([count(t.as_py() or "") for t in texts], pa.int64())

    return n_tokens


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text") -> dict[str, int]:
    """Lengths of the most frequent pieces of a bounded sample of the documents."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(p for p in WITH_SPACE.findall(text.as_py() or "") if len(p) <= LONGEST_KEPT)
        often = [(p, n) for p, n in seen.most_common(TABLE)]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in often], pa.string()), pa.array([n for _, n in often], pa.int64())], ["piece", "n"])

    parts = max(1, docs.count() // SAMPLE)
    some = docs.select(text_col).where(F.pmod(F.xxhash64(text_col), F.lit(parts)) == 0)
    top = some.mapInArrow(pieces, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1")
    top = top.orderBy(F.desc("n"), "piece").limit(TABLE)
    encoder = Encoder(path, lower=False)
    return {r.piece: len(encoder.ids(r.piece)) for r in top.collect()}  # at most TABLE rows


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every document."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        _counter(table, path)(F.col(text_col)).alias("n_tokens"),
    )
