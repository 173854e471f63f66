"""The best phrases of two to four words of each language, by best-first branch-and-bound growth.

``f`` counts a phrase, a = f(phrase); a cut after k words gives l = f(first k), r = f(rest) and floor(2000000 * a / (l + r)),
the lowest cut is the score. As r >= a and l >= a, a score of T needs a >= T * f / (2000000 - T) for the first word's
f and for the last one's. That ``need`` bounds every phrase that a prefix can grow to, because no phrase is more frequent
than its prefix: a prefix under the need of its first word is closed.

Growth goes in waves of falling T. A wave grows word pairs, triples and quadruples whose prefix is still open,
scores what can reach T, and drops what a longer phrase contains. A language with 2000 survivors of T or more is settled:
whatever was not grown scores less. The last wave has T = 0 and leaves only the frequency of 30 as a bound.
One word more is enough to look at for the longer phrases: if two more words keep 80 %, so does one of them.

Texts are split once, into blocks: a table of the block's distinct words and the words' numbers in order, 0
between pieces. A word is a 64-bit hash of language and word; a second word with that hash would be noticed, and the blocks made anew
with another seed. Phrases are tuples of hashes, counted in a block by numpy and then by Spark, combined before the shuffle.
What a wave's scan has to know is of fixed size: for ``SLOTS`` hash slots the greatest f and the least need of the frequent
words there, and bitmaps of ``BITS`` bits of open prefixes and wanted phrases. Full slots and bitmaps let more through,
never less; exact counts decide.

Defined cases: null text counts as empty, null lang as ``und``; copies count each; a language without a phrase of 30
occurrences has no row, so an empty table gives none; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkledger.llm.common import UPPER, landed

LEAST, TOP, LONGEST = 30, 2000, 4
#: A phrase goes if a longer one has so many per cent of its occurrences.
WHOLE = 80
SCALE = 2_000_000
#: Score bounds of the waves.
WAVES = (50_000, 2_000, 0)
SLOTS, BITS, BUCKET = 1 << 20, 1 << 26, 1 << 15
#: Blocks in a file, and counts that a worker hands over at once: both stand in an executor's memory as a whole.
PER_FILE, AT_ONCE = 2, 1 << 16
#: Where pieces end, as text: fixed values.
_ENDS = ".,;:!?\n\v\f\r"
_TABLE = bytes.maketrans((UPPER + _ENDS + "\t").encode(), (UPPER.lower() + "." * len(_ENDS) + " ").encode())
_BLOCK = "lang array<string>, word array<string>, hash array<bigint>, n array<bigint>, tokens array<int>"
_KEYS = [f"w{i}" for i in range(1, LONGEST + 1)]
_COUNTS = ", ".join(f"{k} bigint" for k in _KEYS) + ", n bigint"


class _Numbers(dict):
    """Words of one language in a block, numbered over all its languages."""

    def __init__(self, lang: str, words: list[tuple[str, bytes]]):
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = n = len(self.words)
        return n


def _blocks(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.string())
        for batch in batches:
            words: list[tuple[str, bytes]] = []
            langs: dict[str, _Numbers] = {}
            tokens = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                number = langs.get(lang)
                if number is None:
                    number = langs[lang] = _Numbers(lang, words)
                    number[b"."] = 0
                split = (text.as_py() or "").encode().translate(_TABLE).replace(b".", b" . ").split(b" ")
                tokens.append(np.fromiter(map(number.__getitem__, filter(None, split)), dtype=np.int32))
                tokens.append(np.zeros(1, dtype=np.int32))
            all_tokens = np.concatenate(tokens)
            n = np.bincount(all_tokens, minlength=len(words) + 1)[1:]
            hashes = [xxhash.xxh64_intdigest(lang.encode() + b"\0" + w, seed) for lang, w in words]
            hashes = np.array(hashes, dtype=np.uint64).view(np.int64)
            columns = [
                pa.array([[lang for lang, _ in words]], kind), pa.array([[w.decode() for _, w in words]], kind),
                *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for v in (hashes, n.astype(np.int64), all_tokens)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "hash", "n", "tokens"])

    return run


def _split(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks, and lang, word, hash, n of every word."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    seed = 0
    while True:
        blocks = landed(texts.mapInArrow(_blocks(seed), _BLOCK), "word-blocks", per_file=PER_FILE)
        one = blocks.select(F.explode(F.arrays_zip("lang", "word", "hash", "n")).alias("x")).select("x.*")
        words = landed(one.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("hash").count().where("count > 1").isEmpty():
            return blocks, words
        seed += 1


def _mixed(columns: list) -> np.ndarray:
    """A bit number for each tuple of hashes, as ``_bit`` has it."""
    out = columns[0].copy()
    for i, c in enumerate(columns[1:], 1):
        out ^= (c << np.uint64(13 * i)) | (c >> np.uint64(64 - 13 * i))
    return out & np.uint64(BITS - 1)


def _bit(keys: list[str]) -> Column:
    parts = [keys[0], *(f"(shiftleft({k}, {13 * i}) | shiftrightunsigned({k}, {64 - 13 * i}))" for i, k in enumerate(keys[1:], 1))]
    return F.expr(f"({' ^ '.join(parts)}) & {BITS - 1}L")


def _bitmap(phrases: DataFrame, size: int) -> np.ndarray:
    """A bitmap of phrases of ``size`` words; combined by Spark, of fixed size on the driver."""
    some = phrases.select(_bit(_KEYS[:size]).alias("bit"))
    rows = some.groupBy(F.expr(f"bit div {BUCKET}").alias("bucket")).agg(F.expr(f"bitmap_construct_agg(bit % {BUCKET})").alias("bits"))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in rows.collect():  # BITS / BUCKET rows at most
        out[r.bucket * BUCKET // 8 : (r.bucket + 1) * BUCKET // 8] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def _has(bitmap: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1


def _slots(open_words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """By slot, the greatest count and the least need of the words there; numbers beyond 31 bits count as the greatest of these."""
    most = np.iinfo(np.int32).max
    slot = F.expr(f"hash & {SLOTS - 1}L").alias("slot")
    rows = open_words.groupBy(slot).agg(F.least(F.max("n"), F.lit(most)), F.least(F.min("need"), F.lit(most))).collect()  # SLOTS rows at most
    table = np.array(rows, dtype=np.int64).reshape(-1, 3)
    count, need = np.zeros(SLOTS, dtype=np.int32), np.full(SLOTS, most, dtype=np.int32)
    count[table[:, 0]], need[table[:, 0]] = table[:, 1], table[:, 2]
    return count, need


def _unique(tokens: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct phrases that start at the given places, by one place of each, and how often each does."""
    wide = np.int64(tokens.max(initial=0)) + 1
    key = tokens[at].astype(np.int64)
    for i in range(1, size):
        key = key * wide + tokens[at + i]
        if i + 1 < size:
            key = np.unique(key, return_inverse=True)[1]
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return at[first], n


def _in_turn(*columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of one length, ``AT_ONCE`` rows after the other."""
    for start in range(0, len(columns[0]), AT_ONCE):
        yield tuple(c[start : start + AT_ONCE] for c in columns)


def _scan(blocks: DataFrame, work, picks) -> DataFrame:
    """Counts of the phrases at the places that ``picks`` finds; it gets the broadcast ``work`` and a block, and gives (size, places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = work.value
        for batch in batches:
            for row in range(batch.num_rows):
                hashes = np.r_[np.int64(0), batch.column(0)[row].values.to_numpy()].view(np.uint64)
                tokens = batch.column(1)[row].values.to_numpy()
                slot = hashes & np.uint64(SLOTS - 1)
                count, need = known["count"][slot], known["need"][slot]
                count[0] = 0
                for size, at in picks(known, tokens, hashes, count, need):
                    for at, n in _in_turn(*_unique(tokens, at, size)):
                        columns = [hashes[tokens[at + i]].view(np.int64) if i < size else np.zeros(len(at), np.int64) for i in range(LONGEST)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, n.astype(np.int64))], [*_KEYS, "n"])

    counts = blocks.select("hash", "tokens").mapInArrow(run, _COUNTS).groupBy(*_KEYS).agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST)


def _frequent(tokens: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """Places of phrases of frequent words, all in one piece."""
    ok = count[tokens] > 0
    n = max(0, len(tokens) - size + 1)
    return np.flatnonzero(np.logical_and.reduce([ok[i : i + n] for i in range(size)]))


def _bits_at(tokens: np.ndarray, hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    return _mixed([hashes[tokens[at + i]] for i in range(size)])


def _growing(size: int):
    """Places of phrases whose prefix is open and whose words are all as frequent as the first one needs."""

    def picks(known, tokens, hashes, count, need):
        at = _frequent(tokens, count, size)
        least = need[tokens[at]]
        for i in range(1, size):
            ok = count[tokens[at + i]] >= least
            at, least = at[ok], least[ok]
        if size > 2:
            at = at[_has(known["open"], _bits_at(tokens, hashes, at, size - 1))]
        return [(size, at)]

    return picks


def _wanted(known, tokens, hashes, count, need):
    """Places of the rests of phrases, and of phrases of one word more than a phrase they begin or end with."""
    out = []
    pair, triple = (np.zeros(len(tokens) + 1, dtype=bool) for _ in range(2))
    for size, has in ((2, pair), (3, triple)):
        at = _frequent(tokens, count, size)
        bits = _bits_at(tokens, hashes, at, size)
        has[at] = _has(known["phrases", size], bits)
        rest = at[_has(known["rests", size], bits)]
        if size == 3:
            rest = np.union1d(rest, at[pair[at] | pair[at + 1]])
        out.append((size, rest))
    at = _frequent(tokens, count, 4)
    out.append((4, at[triple[at] | triple[at + 1]]))
    return out


def _of(counts: DataFrame, at: range, names: str) -> DataFrame:
    """Counts of phrases under the names of words ``at`` of a longer one."""
    return counts.select(*[F.col(_KEYS[i]).alias(_KEYS[a]) for i, a in enumerate(at)], F.col("n").alias(names))


def _scored(phrases: DataFrame, size: int, words: DataFrame, grown: dict[int, DataFrame], rests: DataFrame) -> DataFrame:
    """w1 to w4, a, l, r and score of phrases of ``size`` words."""
    out, cuts = phrases.withColumnRenamed("n", "a"), []
    for k in range(1, size):
        first, rest = range(k), range(k, size)
        for part, name in ((first, "l"), (rest, "r")):
            if len(part) == 1:
                counts = words.select(F.col("hash").alias(_KEYS[part[0]]), F.col("n").alias(f"{name}{k}"))
            else:
                where = "w3 = 0" if len(part) == 2 else "w4 = 0"
                counts = _of(grown[len(part)] if name == "l" else rests.where(where), part, f"{name}{k}")
            out = out.join(counts, [_KEYS[i] for i in part])
        cuts.append(f"struct(CAST({SCALE} AS decimal(7, 0)) * CAST(a AS decimal(20, 0)) div (l{k} + r{k}) AS score, {k} AS k, l{k} AS l, r{k} AS r)")
    best = F.expr(f"least({', '.join(cuts)})" if len(cuts) > 1 else cuts[0]).alias("best")
    return out.select(*_KEYS, "a", best).select(*_KEYS, "a", "best.l", "best.r", "best.score")


def _dropped(counts: DataFrame) -> DataFrame:
    """Phrases, and the most occurrences of one with one word more."""
    parts = []
    for size in (3, 4):
        longer = counts.where("w3 <> 0 AND w4 = 0" if size == 3 else "w4 <> 0")
        for a in (0, 1):
            keys = [F.col(k).alias(name) for k, name in zip(_KEYS[a : a + size - 1], _KEYS, strict=False)]
            parts.append(longer.select(*keys, *[F.lit(0).cast("long").alias(k) for k in _KEYS[size - 1 :]], "n"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*_KEYS).agg(F.max("n").alias("longer"))


def _wave(blocks: DataFrame, words: DataFrame, least: int, top: int) -> DataFrame | None:
    """All surviving phrases with a score of ``least`` or more, of the languages of ``words`` (hash, lang, n).

    None if no language has ``top`` phrases that can reach that score, so that none can be settled.
    """
    langs = words.select(F.col("hash").alias("w1"), "lang")
    bound = f"CAST(ceil(CAST(n AS decimal(20, 0)) * {least} / {SCALE - least}) AS bigint)"
    words = words.select("hash", "n", F.expr(f"greatest({LEAST}L, {bound})").alias("need"))
    count, need = _slots(words)
    context = blocks.sparkSession.sparkContext
    grown: dict[int, DataFrame] = {}
    reach: dict[int, DataFrame] = {}
    for size in range(2, LONGEST + 1):
        known = {"count": count, "need": need}
        if size > 2:
            known["open"] = _bitmap(grown[size - 1], size - 1)
        shared = context.broadcast(known)
        counts = _scan(blocks, shared, _growing(size))
        first = words.select(F.col("hash").alias("w1"), F.col("need").alias("first"))
        last = words.select(F.col("hash").alias(_KEYS[size - 1]), F.col("need").alias("last"))
        grown[size] = landed(counts.join(first, "w1").where("n >= first").join(last, _KEYS[size - 1]), "grown")
        shared.destroy()
        reach[size] = grown[size].where("n >= last").select(*_KEYS, "n")
        grown[size] = grown[size].select(*_KEYS, "n")
    if least:
        every = reach[2].unionByName(reach[3]).unionByName(reach[4])
        if every.join(langs, "w1").groupBy("lang").count().where(F.col("count") >= top).isEmpty():
            return None
    rests = {k: [reach[s].select(*[F.col(_KEYS[s - k + i]).alias(_KEYS[i]) for i in range(k)]) for s in range(k + 1, LONGEST + 1)] for k in (2, 3)}
    known = {"count": count, "need": need}
    for k in (2, 3):
        every = rests[k][0]
        for r in rests[k][1:]:
            every = every.unionByName(r)
        known["rests", k], known["phrases", k] = _bitmap(every, k), _bitmap(reach[k], k)
    shared = context.broadcast(known)
    counts = landed(_scan(blocks, shared, _wanted), "wanted")
    shared.destroy()
    scored = None
    for size in range(2, LONGEST + 1):
        some = _scored(reach[size], size, words, grown, counts).where(F.col("score") >= least)
        scored = some if scored is None else scored.unionByName(some)
    found = scored.join(_dropped(counts), _KEYS, "left")
    found = found.where(F.expr(f"longer IS NULL OR 100 * longer < {WHOLE} * a")).drop("longer")
    return landed(found.join(langs, "w1"), "survivors")


def phrases(docs: DataFrame, top: int = TOP, waves: tuple[int, ...] = WAVES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each language."""
    blocks, words = _split(docs)
    frequent = landed(words.where(F.col("n") >= LEAST), "frequent-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    texts = frequent.select("hash", "lang", "word")
    left, done = frequent, []
    for least in waves:
        found = _wave(blocks, left, least, top)
        if found is None:
            continue
        if least:
            settled = landed(found.groupBy("lang").count().where(F.col("count") >= top).select("lang"), "settled")
            done.append(found.join(settled, "lang", "left_semi"))
            left = landed(left.join(settled, "lang", "left_anti"), "unsettled")
            if left.isEmpty():
                break
        else:
            done.append(found)
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    for i, k in enumerate(_KEYS):
        every = every.join(texts.select(F.col("hash").alias(k), F.col("word").alias(f"t{i}")), k, "inner" if i < 2 else "left")
    phrase = F.concat_ws(" ", *[f"t{i}" for i in range(LONGEST)])
    ranked = every.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
