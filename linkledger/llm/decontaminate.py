"""Benchmark decontamination: rare seeds join texts to test items, Smith-Waterman alignment scores them.

Words are runs of letters, digits and characters beyond ASCII, in lower case. A document is contaminated
by an item when the best local alignment of their words reaches ``SCORE`` of the item's own score and
``MIN_WORDS`` words match; that holds for edited copies too. Shorter items are found where all their words stand
consecutively.

Seeds lose nothing. With m matches and e errors the score is 2m - e, so half of the item's own score needs half of its n word
places matched, h = ceil(n / 2). Of the n - h + s rarest places (by how many items have the word), s must therefore be among
the matches: these are the seeds, unigrams, because an edited copy may share no longer run. Each item has the s that other
texts are least likely to reach. A posting list by word gives the items of which a text has s seeds; all other items are never touched. Of these, only
stretches that can't reach the score are left out: an alignment of score T with m matches needs T - m - 1 matching pairs
of neighbours or more. So the hits are those of aligning every item with every document.

The test items are the small side. They are taken in slices of at most about ``SLICE_WORDS`` words, ``AT_ONCE`` of them in one
pass over the documents, so what is broadcast doesn't grow with either table. Documents stay where
they are read: no pair is shuffled, and a passage in a third of all documents costs its alignments.

Defined cases: null text of a document or item has no words, and items without words contaminate nothing; equal items are
reported each; repeated documents are reported each; item ids are whole numbers or, of any other type, texts; empty tables
give no hits; extra columns are passed on by :func:`without_test_items` and otherwise not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.llm import licenses
from linkledger.llm.common import landed

MATCH, MISMATCH, GAP = 2, -1, -1
SCORE = 0.5
MIN_WORDS = 8
#: How many items' lengths a text is taken for, when the seeds are chosen.
LENGTHS = 8
SLICE_WORDS, AT_ONCE = 500_000, 4
#: Words of a text that are looked at together; more for items of more than a quarter of that.
STRETCH = 256


def words_of(text: str | None) -> list[bytes]:
    return licenses.words_of((text or "").lower())


class Items:
    """Test items as word numbers, and posting lists of their seeds."""

    def __init__(self, items: list[tuple[int | str | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words = [], []
        #: Shorter items by their length: their words, and the ids of each.
        self.short: dict[int, dict[tuple[int, ...], list]] = {}
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if len(words) >= MIN_WORDS:
                self.ids.append(item_id)
                self.words.append(np.array(words, dtype=np.int64))
            elif words:
                self.short.setdefault(len(words), {}).setdefault(tuple(words), []).append(item_id)
        self._post()

    def _post(self) -> None:
        """Posting lists: for each word the items it is a seed of, and how often; of each item the seeds to be met."""
        often = np.zeros(len(self.vocabulary) + 1, dtype=np.int64)
        for words in self.words:
            often[np.unique(words)] += 1
        word, item, times = ([np.empty(0, np.int64)] for _ in range(3))
        self.least = np.zeros(len(self.words), dtype=np.int64)
        chance = 1 - (1 - often / max(1, len(self.words))) ** LENGTHS  # that a text has a word, about
        for i, words in enumerate(self.words):
            order = np.argsort(chance[words], kind="stable")
            expected = np.cumsum(chance[words][order])
            spare = len(words) - int(np.ceil(SCORE * len(words)))
            need = np.arange(1, len(words) - spare + 1)
            best = int(((need - expected[spare:]) / np.sqrt(expected[spare:] + 0.5)).argmax())
            self.least[i] = need[best]
            seeds, count = np.unique(words[order[: spare + 1 + best]], return_counts=True)
            word.append(seeds)
            item.append(np.full(len(seeds), i))
            times.append(count)
        word, self.item, self.times = (np.concatenate(v) for v in (word, item, times))
        order = np.argsort(word, kind="stable")
        self.item, self.times = self.item[order], self.times[order]
        self.start = np.searchsorted(word[order], np.arange(len(self.vocabulary) + 2))

    def numbers(self, text: str | None) -> np.ndarray:
        """A text's words as numbers; 0 for words that no item has."""
        get, words = self.vocabulary.get, words_of(text)
        return np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))

    def met(self, numbers: np.ndarray) -> np.ndarray:
        """The items of which a text has as many seeds as an alignment needs."""
        words = np.unique(numbers)
        first, n = self.start[words], self.start[words + 1] - self.start[words]
        first, n = first[(n > 0) & (words > 0)], n[(n > 0) & (words > 0)]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        seeds = np.bincount(self.item[at], self.times[at], len(self.words))
        return np.flatnonzero((seeds >= self.least) & (self.least > 0))

    def _class(self, some: np.ndarray) -> tuple:
        """Of items: greatest length, numbers, words, where each starts, least score, bigrams and their numbers by word."""
        size = np.array([len(self.words[i]) for i in some], dtype=np.int64)
        words = np.concatenate([self.words[i] for i in some])
        starts = np.cumsum(size) - size
        pair = np.r_[words[:-1] * (len(self.vocabulary) + 1) + words[1:], 0]
        pair[np.r_[starts[1:], len(words)] - 1] = 0  # an item's last word begins none
        bigrams, which = np.unique(pair, return_inverse=True)
        return int(size.max()), some, words, starts, np.ceil(SCORE * MATCH * size), bigrams, which

    def candidates(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, stop) of all stretches of a text in which an alignment can reach ``SCORE``.

        The matches of m form at most e + 1 runs, so an alignment of score T has T - m - 1 matching pairs of neighbours
        or more, and m is at least T / 2. Its stretch has at most twice the item's words. Each stretch is asked for
        item words and pairs of neighbours that occur anywhere in it, items of about one length together.
        """
        some = self.met(numbers)
        if not len(some):
            return
        pair = numbers[:-1] * (len(self.vocabulary) + 1) + numbers[1:]
        pair[(numbers[:-1] == 0) | (numbers[1:] == 0)] = -1
        bits = np.array([len(self.words[i]).bit_length() for i in some])
        for n in np.unique(bits):
            for left, a, b in self._stretches(self._class(some[bits == n]), numbers, pair, STRETCH):
                for i in left.tolist():
                    yield i, a, b

    def verbatim(self, numbers: np.ndarray) -> Iterator[tuple[int | str | None, int, int]]:
        """(id, first word, words) of the short items whose words stand consecutively in a text."""
        for n, known in self.short.items():
            if len(numbers) < n:
                continue
            begins = np.flatnonzero(np.isin(numbers[: len(numbers) - n + 1], [w[0] for w in known]))
            found: dict[tuple[int, ...], int] = {}
            for at in begins.tolist():
                found.setdefault(tuple(numbers[at : at + n].tolist()), at)
            for words, at in found.items():
                for item_id in known.get(words, []):
                    yield item_id, at, n

    def _stretches(self, items: tuple, numbers: np.ndarray, pair: np.ndarray, least_span: int) -> Iterator[tuple[np.ndarray, int, int]]:
        longest, some, words, starts, least, bigrams, which = items
        span = max(4 * longest, least_span)
        at = np.minimum(np.searchsorted(bigrams, pair), len(bigrams) - 1)
        at[bigrams[at] != pair] = -1
        has, pairs = np.zeros(len(self.vocabulary) + 1, dtype=bool), np.zeros(len(bigrams), dtype=bool)
        for a in range(0, max(1, len(numbers) - 2 * longest), span - 2 * longest):
            b = min(a + span, len(numbers))
            seen, joined = numbers[a:b], at[a : max(a, b - 1)]
            has[seen] = True
            has[0] = False
            m = np.add.reduceat(has[words], starts, dtype=np.int32)
            has[seen] = False
            ok = MATCH * m >= least
            if ok.any():
                joined = joined[joined >= 0]
                pairs[joined] = True
                ok &= m + np.add.reduceat(pairs[which], starts, dtype=np.int32) >= least - 1
                pairs[joined] = False
                if ok.any():
                    yield some[ok], a, b

    def hits(self, text: str | None) -> list[dict]:
        """The items that contaminate a text, best alignment each."""
        numbers = self.numbers(text)
        spans: dict[int, list[tuple[int, int]]] = {}
        if self.words and len(numbers):
            for item, low, high in self.candidates(numbers):
                spans.setdefault(item, []).append((low, high))
        out = [{"item_id": i, "score": 1.0, "first_word": at, "n_words": n} for i, at, n in self.verbatim(numbers)]
        for item, windows in spans.items():
            words = self.words[item]
            best = max((align(words, numbers[a:b]) + (a,) for a, b in windows), key=lambda x: x[0])
            score, start, stop, low = best
            share = score / (MATCH * len(words))
            # each word beyond the matches costs, so the score bounds the matches from below
            if share >= SCORE and score >= MATCH * MIN_WORDS:
                out.append({"item_id": self.ids[item], "score": share, "first_word": low + start, "n_words": stop - start})
        return sorted(out, key=lambda h: (h["item_id"] is None, h["item_id"]))


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment of word numbers, and its start and stop in ``b``. Zeros match nothing."""
    score, stop = _best(a, b)
    if not score:
        return 0, 0, 0
    _, back = _best(a[::-1], b[:stop][::-1], score)
    return score, stop - back, stop


def _best(a: np.ndarray, b: np.ndarray, until: int | None = None) -> tuple[int, int]:
    """The best score and the first end in ``b`` that reaches it (or reaches ``until``)."""
    row, slope = np.zeros(len(b) + 1, dtype=np.int64), -GAP * np.arange(len(b) + 1)
    best, end = 0, 0
    for word in a.tolist():
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(b == word, MATCH, MISMATCH))
        row = np.maximum.accumulate(new + slope) - slope  # gaps along b
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
            if until is not None and best >= until:
                break
    return best, end


def _slices(benchmark: DataFrame) -> Iterator[list[Items]]:
    """The test items, as many slices at once as one pass over the documents takes; each is small enough for the driver."""
    items = benchmark.select(F.col("item_id").cast(_id_type(benchmark)).alias("item_id"), "text")
    words = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = words // (6 * SLICE_WORDS) + 1  # five letters and a space a word, or more slices
    for first in range(0, slices, AT_ONCE):
        some = range(first, min(first + AT_ONCE, slices))
        of = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
        yield [Items(sorted(map(tuple, items.where(of == k).collect()), key=repr)) for k in some]


def _id_type(benchmark: DataFrame) -> T.DataType:
    return T.LongType() if isinstance(benchmark.schema["item_id"].dataType, T.IntegralType) else T.StringType()


def _found(docs: DataFrame, slices: list[Items], id_type: T.DataType, text_col: str) -> Column:
    """An array with the test items found in the text of each row: item_id, score, first_word, n_words."""
    shared = [docs.sparkSession.sparkContext.broadcast(s) for s in slices]
    return F.concat(*[_hits_udf(s, id_type)(F.col(text_col)) for s in shared])


def _hits_udf(shared, id_type: T.DataType):
    of = pa.int64() if isinstance(id_type, T.LongType) else pa.string()
    kind = pa.list_(pa.struct([("item_id", of), ("score", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    @F.arrow_udf(f"array<struct<item_id: {id_type.simpleString()}, score: double, first_word: bigint, n_words: bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shared.value.hits(t.as_py()) for t in texts], kind)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """A row for each document and test item that is in it: doc_id, item_id, score, first_word, n_words."""
    every, id_type = None, _id_type(benchmark)
    for slices in _slices(benchmark):
        hits = docs.select("doc_id", F.explode(_found(docs, slices, id_type, text_col)).alias("h")).select("doc_id", "h.*")
        every = hits if every is None else every.unionByName(landed(hits, "hits"))
    return every


def without_test_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that hold no test item. Beyond ``AT_ONCE`` slices what is left is landed after each pass."""
    for k, slices in enumerate(_slices(benchmark)):
        docs = (landed(docs, "clean") if k else docs).where(F.size(_found(docs, slices, _id_type(benchmark), text_col)) == 0)
    return docs
