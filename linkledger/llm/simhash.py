"""Near-duplicates by 64-bit SimHash and anchor points of a covering code.

Fingerprints link when they differ in at most three bits; components of links are the groups.
Anchors are the code words of two perfect Golay [23, 12] codes (covering radius 3), one on
each of two disjoint sets of 23 bits, so an anchor is a pair of code words. Two
fingerprints that differ in three bits have a point between them, two flips from one and one
from the other; both are replicated to the anchor that covers that point. Each therefore goes
to all anchors that cover a point within two flips of it, all of them within the covering
radius plus the threshold: 68 of 16.8 million for most. Fingerprints that meet at an anchor are compared;
what links them is passed on as a forest, not as all pairs. With more than some 10^9 different
fingerprints the third code in ``CODES`` keeps anchors small.

Equal fingerprints are one before anything is replicated, so copies cost nothing. An anchor
with more than ``CROWD`` fingerprints isn't compared pair by pair: its fingerprints meet at
every point within two flips instead (2,081 each), where the least one within one flip is the
hub for all that came. That is linear in the crowd, finds the same components, and spreads a
crowd over as many tasks as it has points.

Defined cases: null text counts as empty; documents without words have fingerprint zero and
link like any other; a null doc_id is no candidate for the component's id unless all are null;
repeated rows are kept; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.llm.common import landed, unused
from linkledger.llm.components import connected_components

SHINGLE = 3
THRESHOLD = 3
#: (length, generator polynomial) of perfect cyclic codes: Golay [23, 12], and Hamming [15, 11] as a third.
GOLAY, HAMMING = (23, 0xC75), (15, 0x13)
CODES = (GOLAY, GOLAY)
#: Most fingerprints that are compared pair by pair at an anchor.
CROWD = 1024
#: Up to so many at an anchor are compared by shifting, more by a square of distances.
FEW = 32
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of the XXH64 (seed 42) of word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else iter([b" ".join(words)])
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), joined), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 15):
        part = hashes[i : i + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


@F.arrow_udf(T.LongType())
def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        prints = np.fromiter((fingerprint(t.as_py()) for t in texts), dtype=np.uint64, count=len(texts))
        yield pa.array(prints.view(np.int64))


@lru_cache
def _code(length: int, poly: int) -> tuple[list[np.ndarray], list[list[np.ndarray]]]:
    """Of a perfect code: tables that give the syndrome of the low 12 and of the other bits; for 0, 1 and 2 flips, by syndrome, the masks from a word to the code words that cover points so many flips away and not fewer (-1 where there are no more)."""
    degree = poly.bit_length() - 1

    def rest(v: int) -> int:
        while v.bit_length() > degree:
            v ^= poly << (v.bit_length() - 1 - degree)
        return v

    column = [rest(1 << i) for i in range(length)]
    leader = {0: 0}
    for weight in range(1, 4):
        for at in combinations(range(length), weight):
            s = 0
            for i in at:
                s ^= column[i]
            leader.setdefault(s, sum(1 << i for i in at))
    flips = [[(0, 0)], [(1 << i, column[i]) for i in range(length)], [(1 << i | 1 << j, column[i] ^ column[j]) for i, j in combinations(range(length), 2)]]
    masks = []
    seen: list[set[int]] = [set() for _ in range(1 << degree)]
    for some in flips:
        by_syndrome = []
        for s in range(1 << degree):
            new = {e ^ leader[s ^ t] for e, t in some} - seen[s]
            seen[s] |= new
            by_syndrome.append(sorted(new))
        out = np.full((max(map(len, by_syndrome)), 1 << degree), -1, dtype=np.int64)
        for s, new in enumerate(by_syndrome):
            out[: len(new), s] = new
        masks.append(list(out))
    low = np.array([rest(v) for v in range(1 << min(12, length))], dtype=np.int64)
    high = np.array([rest(v << 12) for v in range(1 << max(0, length - 12))], dtype=np.int64)
    return [low, high], masks


def anchors(prints: np.ndarray, codes=CODES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices into ``prints``, anchors) in several parts: all anchors that cover a point within two flips of each."""
    words, options, at = [], [], 0
    for length, poly in codes:
        (low, high), masks = _code(length, poly)
        v = (prints >> np.uint64(at)).astype(np.int64) & ((1 << length) - 1)
        s = low[v & 0xFFF] ^ high[v >> 12]
        words.append((v, at))
        options.append([[m[s] for m in of_flips] for of_flips in masks])
        at += length
    every = np.arange(len(prints))

    def choose(k: int, flips: int, rows: np.ndarray, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if k == len(codes):
            yield rows, anchor
            return
        v, shift = words[k]
        for used in range(flips + 1):
            for mask in options[k][used]:
                m = mask[rows]
                ok = m >= 0
                if ok.any():
                    yield from choose(k + 1, flips - used, rows[ok], anchor[ok] | ((v[rows[ok]] ^ m[ok]) << shift))

    yield from choose(0, 2, every, np.zeros(len(prints), dtype=np.int64))


def _replicate(codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(every), 2048):
                prints = every[i : i + 2048]
                parts = list(anchors(prints.view(np.uint64), codes))
                rows = np.concatenate([r for r, _ in parts])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a for _, a in parts])), pa.array(prints[rows])], ["anchor", "print"])

    return run


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each fingerprint to the first one of its component among these."""
    near = _differ(prints[:, None], prints[None, :]) <= THRESHOLD
    label = np.arange(len(prints))
    while True:
        new = np.where(near, label[None, :], len(prints)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(prints))
    return prints[moved], prints[label[moved]]


def _edges(anchor: np.ndarray, prints: np.ndarray) -> tuple[list, list]:
    """Edges (a, b) inside complete anchor groups of at most CROWD, sorted by anchor."""
    a, b = [], []
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[starts, len(anchor)])
    left = np.repeat(np.where(size <= FEW, size, 0), size) - (np.arange(len(anchor)) - np.repeat(starts, size))
    rows = np.flatnonzero(left > 1)
    shift = 1
    while len(rows):  # a row and the one ``shift`` after it in the same group
        linked = rows[_differ(prints[rows], prints[rows + shift]) <= THRESHOLD]
        a.append(prints[linked + shift])
        b.append(prints[linked])
        shift += 1
        rows = rows[left[rows] > shift]
    for s, n in zip(starts[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
        x, y = _forest(prints[s : s + n])
        a.append(x)
        b.append(y)
    return a, b


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by anchor: edges, and the fingerprints of crowded anchors as edges to themselves."""
    anchor, prints, crowded = np.empty(0, np.int64), np.empty(0, np.int64), None

    def out(a, b, crowd=()):
        none = np.empty(0, np.int64)
        key = np.unique(np.stack([np.concatenate([none, *x, *crowd]) for x in (a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(key[0]), pa.array(key[1])], ["a", "b"])

    for batch in batches:
        anchor = np.concatenate([anchor, batch.column(0).to_numpy(zero_copy_only=False)])
        prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False)])
        if not len(anchor):
            continue
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        size = np.diff(np.r_[starts, len(anchor)])
        is_crowd = (size > CROWD) | (anchor[starts] == crowded if crowded is not None else False)
        if is_crowd[-1]:
            crowded, open_ = int(anchor[-1]), 0
        else:
            open_ = int(size[-1])
        done = np.repeat(~is_crowd, size)
        done[len(anchor) - open_ :] = False
        crowd = np.repeat(is_crowd, size)
        a, b = _edges(anchor[done], prints[done]) if done.any() else ([], [])
        yield out(a, b, [prints[crowd]])
        anchor, prints = anchor[len(anchor) - open_ :], prints[len(prints) - open_ :]
    if len(anchor):
        yield out(*_edges(anchor, prints))


def _ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every point within two flips of each fingerprint; far is 1 beyond one flip."""
    one = [np.uint64(1) << np.uint64(i) for i in range(64)]
    flips = np.array([np.uint64(0), *one, *(x | y for x, y in combinations(one, 2))], dtype=np.uint64)
    far = np.repeat(np.array([0, 1], dtype=np.int8), [65, len(flips) - 65])
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for i in range(0, len(every), 64):
            prints = every[i : i + 64]
            points = (prints.view(np.uint64)[:, None] ^ flips[None, :]).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(points), pa.array(np.tile(far, len(prints))), pa.array(np.repeat(prints, len(flips)))], ["point", "far", "print"]
            )


def _hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by point, far and print: edges from what came to a point to its first near fingerprint."""
    last, hub = None, None
    for batch in batches:
        point, far, prints = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(point):
            continue
        first = np.r_[point[0] != last if last is not None else True, point[1:] != point[:-1]]
        at = np.maximum.accumulate(np.where(first, np.arange(len(point)), -1))
        hubs = np.where(far[at] == 0, prints[at], 0)
        known = far[at] == 0
        before = at < 0  # goes on with the point of the batch before
        if hub is not None:
            hubs, known = np.where(before, hub, hubs), np.where(before, True, known)
        else:
            known = known & ~before
        last, hub = int(point[-1]), int(hubs[-1]) if known[-1] else None
        ok = known & (hubs != prints)
        yield pa.RecordBatch.from_arrays([pa.array(prints[ok]), pa.array(hubs[ok])], ["a", "b"])


def links(prints: DataFrame, codes=CODES) -> DataFrame:
    """Edges (a, b) that connect just the fingerprints that are linked, over different fingerprints in column ``print``."""
    met = prints.select("print").mapInArrow(_replicate(codes), "anchor long, print long").repartition("anchor").sortWithinPartitions("anchor", "print")
    found = landed(met.mapInArrow(_compare, "a long, b long"), "links")
    crowd = found.where("a = b").select(F.col("a").alias("print")).distinct()
    points = crowd.mapInArrow(_ball, "point long, far byte, print long").repartition("point").sortWithinPartitions("point", "far", "print")
    return found.where("a <> b").unionByName(points.mapInArrow(_hubs, "a long, b long"))


def near_rows(rows: DataFrame) -> DataFrame:
    """rid, doc_id, print and best of rows with a unique rid, a doc_id and a text; best: the row of the group that stays (known, doc_id, rid)."""
    rows = landed(rows.select("rid", "doc_id", _fingerprints("text").alias("print")), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid")).alias("least")
    prints = landed(rows.groupBy("print").agg(first), "distinct-prints")
    roots = connected_components(links(prints))
    nodes = prints.join(roots, prints["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    groups = nodes.groupBy("root").agg(F.min("least").alias("best"))
    return rows.join(nodes.join(groups, "root").select("print", "best"), "print")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    rows = near_rows(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("best.doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the least doc_id (of repeated rows just one)."""
    rid = unused(docs, "rid")
    numbered = landed(docs.withColumn(rid, F.monotonically_increasing_id()), "numbered")
    rows = near_rows(numbered.select(F.col(rid).alias("rid"), "doc_id", "text"))
    stay = rows.where(F.col("best.rid") == F.col("rid")).select(F.col("rid").alias(rid))
    return numbered.join(stay, rid, "left_semi").drop(rid)
