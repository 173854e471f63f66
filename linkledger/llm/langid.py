"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every text is read whole, in lower case, as its characters, pairs and triples of characters, hashed
into ``BUCKETS``. Counts by language, each damped to log(1 + n) within a text so that no text that repeats itself
rules its language, are summed over the training rows by a grouped aggregation; the matrix of log-probabilities (buckets by languages, its size checked) is broadcast, and
batches of texts are scored in numpy as sparse count rows times that matrix.

Training takes about ``PER_LANGUAGE`` rows of each language at most, chosen by a hash of id and text, so that of a
group of copies its share is taken. That bound is the only limit; it concerns fitting alone.

Defined cases: ``und`` with score 0 for null text, for text without a letter, and for all text when
nothing was learnt; ties go to the first language by code point; repeated rows are predicted each; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
GRAMS = 3
PER_LANGUAGE = 10_000
HASHES = 1 << 20
#: Most bytes of the matrix that is broadcast.
MATRIX_BYTES = 256 << 20
#: Added to every count.
SMOOTHING = 0.1
UNKNOWN = "und"
#: A text below this fit is in none of the learnt languages.
LEAST_FIT = -3.0
#: Characters that are scored at once, for four languages; fewer with more.
AT_ONCE = 1 << 17


def _buckets(chars: np.ndarray, room: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, ...: the start of each n-gram inside its text, and its bucket. ``room``: characters left in the text."""
    h = np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, GRAMS + 1):
        h = (h[: len(chars) - n + 1] + chars[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        at = np.flatnonzero(room[: len(h)] >= n)
        yield at, (h[at] * np.uint64(0xD1342543DE82EF95) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of lower-cased texts, and where each text starts (the end appended)."""
    chars = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4") for t in texts]
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    starts[1:] = np.cumsum([len(c) for c in chars])
    return np.concatenate([*chars, np.empty(0, "<u4")]).astype(np.uint64), starts


def _windows(texts: list[str], step: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(characters, text number of each start, characters left in its text) for runs of at most ``step`` starts."""
    chars, starts = _joined(texts)
    for a in range(0, len(chars), step):
        b = min(a + step, len(chars))
        text = np.searchsorted(starts, np.arange(a, b), side="right") - 1
        yield chars[a : b + GRAMS - 1], text, starts[text + 1] - np.arange(a, b)


def _count(names: list[str]):
    place = {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), BUCKETS), dtype=np.int64)
        # A text's counts are summed over all its windows before they are damped.
        held, open_ = np.zeros(BUCKETS, dtype=np.int64), None

        def damped(times: np.ndarray) -> np.ndarray:
            return np.rint(1000 * np.log1p(times)).astype(np.int64)  # whole numbers: sums don't depend on their order

        def close(lang: int) -> None:
            some = np.flatnonzero(held)
            sums[lang, some] += damped(held[some])
            held[some] = 0

        for batch in batches:
            langs = np.array([place[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            for chars, text, room in _windows(batch.column(1).to_pylist(), AT_ONCE):
                keys = np.concatenate([text[at] * BUCKETS + bucket for at, bucket in _buckets(chars, room)])
                row, times = np.unique(keys, return_counts=True)
                of, bucket, last = row // BUCKETS, row % BUCKETS, int(text[-1])
                if open_ is not None and open_ != last:
                    held[bucket[of == open_]] += times[of == open_]
                    close(langs[open_])
                whole = (of != last) & (of != (-1 if open_ is None else open_))
                sums += np.bincount(langs[of[whole]] * BUCKETS + bucket[whole], damped(times[whole]), sums.size).astype(np.int64).reshape(sums.shape)
                held[bucket[of == last]] += times[of == last]
                open_ = last
            if open_ is not None:
                close(langs[open_])
                open_ = None
        lang, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(sums[lang, bucket])], ["lang", "bucket", "n"]
        )

    return run


class Model:
    """Languages in order, log-probabilities (buckets by languages) and log-priors."""

    def __init__(self, names: list[str], sums: np.ndarray, rows: np.ndarray):
        self.names = names
        seen = sums.sum(axis=0) > 0
        smooth = np.where(seen, sums + SMOOTHING, 0.0)
        share = smooth / smooth.sum(axis=1, keepdims=True)
        logs = np.log(np.where(seen, share, 1.0))
        self.matrix = logs.T.astype(np.float32)  # n-grams that no language has say nothing
        self.seen, self.prior = seen, np.log(rows / rows.sum())
        #: What a language's own n-grams have on average, and what those have that no language has.
        self.own = (share * logs).sum(axis=1)
        self.unseen = np.log(SMOOTHING / smooth.sum(axis=1))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best language's number, its posterior probability and the fit (see :func:`predict`)."""
        total, known, every = np.tile(self.prior, (len(texts), 1)), np.zeros(len(texts)), np.zeros(len(texts))
        for chars, text, room in _windows(texts, max(1024, AT_ONCE * 4 // len(self.names))):
            for at, bucket in _buckets(chars, room):
                if len(at):
                    of = text[at]
                    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                    total[of[first]] += np.add.reduceat(self.matrix[bucket], first, axis=0, dtype=np.float64)
                    known[of[first]] += np.add.reduceat(self.seen[bucket], first, dtype=np.float64)
                    every[of[first]] += np.diff(np.r_[first, len(of)])
        best = total.argmax(axis=1)
        top = total[np.arange(len(texts)), best]
        fit = (top - self.prior[best] + (every - known) * self.unseen[best]) / np.maximum(every, 1) - self.own[best]
        return best, 1 / np.exp(total - top[:, None]).sum(axis=1), fit


def train(
    rows: DataFrame, per_language: int = PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id"
) -> Model | None:
    """Fit on rows with a language and a text; None if there are none."""
    labelled = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = dict(sorted((r[0], r[1]) for r in labelled.groupBy(lang_col).count().collect()))  # one row a language
    if not counts:
        return None
    names = list(counts)
    if len(names) * BUCKETS * 4 > MATRIX_BYTES:
        raise ValueError(f"{len(names)} languages: their matrix is too large to broadcast; raise MATRIX_BYTES or lower BUCKETS")
    least = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, int(HASHES * min(1.0, per_language / n)))])
    by = [id_col, text_col] if id_col in rows.columns else [text_col]
    some = labelled.where(F.pmod(F.xxhash64(*by), F.lit(HASHES)) < least[F.col(lang_col)]).select(lang_col, text_col)
    found = some.mapInArrow(_count(names), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros((len(names), BUCKETS))
    sums[found["lang"].to_numpy(dtype=int), found["bucket"].to_numpy(dtype=int)] = found["n"].to_numpy(dtype=float) / 1000
    return Model(names, sums, np.array(list(counts.values()), dtype=float))


def predict(df: DataFrame, model: Model | None, text_col: str = "text") -> Column:
    """A struct of lang_pred, score and fit for the text of each row.

    ``score`` is the posterior among the learnt languages, which says nothing of others; ``fit`` is the mean log-probability of
    the text's n-grams less that of the language's own, so text in another script or of random letters is far below
    zero. It is null where no language is told.
    """
    kind = "struct<lang_pred: string, score: double, fit: double>"
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).alias("fit")).cast(kind)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores, fits = [UNKNOWN] * len(batch), np.zeros(len(batch)), np.full(len(batch), np.nan)
            for a in range(0, len(batch), 128):
                texts = {a + i: t for i, t in enumerate(batch.slice(a, 128).to_pylist()) if t and any(map(str.isalpha, t))}
                if texts:
                    best, scores[list(texts)], fits[list(texts)] = shared.value.score(list(texts.values()))
                    for i, b in zip(texts, best.tolist(), strict=True):
                        names[i] = shared.value.names[b]
            columns = [pa.array(names, pa.string()), pa.array(scores), pa.array(fits, from_pandas=True)]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score", "fit"])

    return run(F.col(text_col))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training doesn't see."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learnt from those that aren't held out."""
    answer = predict(docs, train(docs.where(~held_out())))
    return docs.select("doc_id", held_out().alias("held_out"), answer.alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
