"""Document quality by hierarchical empirical Bayes.

A logistic classifier on the make-up of the whole text gives each document evidence of its own.
Hosts and paths add theirs: the labels of a site's documents, or the classifier's probabilities where
there are none, are summed by grouped aggregation; a host's mean is shrunk towards the global
one, a path's towards its host's, each by a strength estimated from the spread between sites
(method of moments). Sparse sites stay near the prior, large ones speak for themselves. A document's
own share is taken out of its site before the two are combined, so it doesn't count twice.

The classifier is fitted on at most about ``FIT_ROWS`` labelled rows; the prior is the mean of all labels, and sums over
sites cover all documents.

Defined cases: null text counts as empty; null host or path is a site of its own; labels with a null
id or quality are ignored, several labels of a document are averaged; repeated rows are scored each;
without labels every score is the prior 0.5; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkledger.llm.common import landed

FIT_ROWS = 50_000
HASHES = 1 << 20
#: A site's spread is kept within these strengths (documents that the prior counts for).
STRENGTHS = (2.0, 1000.0)
#: Documents differ from their site's mean; evidence beyond this log-odds isn't believed.
MOST = 12.0
_KIND = np.zeros(256, dtype=np.int64)
_KIND[list(b" \t\n\r\x0b\x0c")] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("a") : ord("z") + 1] = 3
_KIND[ord("0") : ord("9") + 1] = 4
_KIND[list(b".,;:'\"!?-()")] = 5
_KIND[128:] = 6
FEATURES = 12


def features(text: str | None) -> list[float]:
    """Shares of kinds of characters, of different words and lines, of short and long words, and the length."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data.strip():
        return [0.0] * FEATURES
    kinds = np.bincount(_KIND[np.frombuffer(data, dtype=np.uint8)], minlength=7) / len(data)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = len(words)
    ends = sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines)
    return [*kinds[[0, 2, 3, 4, 5, 6]].tolist(), len(set(words)) / n, len(set(lines)) / len(lines), len(data) / n / 10, data.count(b"!") / len(data) * 10, ends, np.log1p(n) / 10]


def _features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (with the constant first), means and scales of a ridge logistic regression, by Newton steps."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w, keep = np.zeros(z.shape[1]), np.r_[1e-3, np.full(x.shape[1], ridge)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(keep)
        step = np.linalg.solve(h, z.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w, mean, scale


def _strength(sites: DataFrame, prior: float) -> float:
    """Method of moments: how many documents the prior counts for, given sites with columns n and s."""
    v = prior * (1 - prior)
    n, total, squares, spread = sites.agg(
        F.count("*"), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - prior, 2))
    ).first()
    if not n or n < 2 or v <= 0 or total <= 0 or total - squares / total <= 0:
        return STRENGTHS[1]
    between = (spread - (n - 1) * v) / (total - squares / total)
    return float(np.clip(v / between - 1 if between > 0 else STRENGTHS[1], *STRENGTHS))


def _odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def score_documents(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, doc_quality (the classifier's), host_quality, path_quality (posterior means) and score (all combined) of every document."""
    make_up = F.arrow_udf(_features, "array<double>")
    rows = landed(
        docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"), make_up("text").alias("x"), F.monotonically_increasing_id().alias("rid")),
        "quality",
    )
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("label"))
    rows = rows.join(known, "doc_id", "left")
    labelled = rows.where("label IS NOT NULL")
    n, mean_label = labelled.agg(F.count("*"), F.avg("label")).first()
    # A share of the rows by hash, so that about FIT_ROWS are met however many there are.
    least = int(HASHES * min(1.0, FIT_ROWS / max(n, 1)))
    some = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < least).select("x", "label").collect()
    if not some:
        half = F.lit(0.5)
        return rows.select("doc_id", half.alias("doc_quality"), half.alias("host_quality"), half.alias("path_quality"), half.alias("score"))
    y = np.array([r.label for r in some])
    w, mean, scale = fit(np.array([r.x for r in some]), y)
    prior = float(np.clip(mean_label, 0.001, 0.999))
    odds = F.lit(float(w[0] - (w[1:] / scale) @ mean))
    for i, k in enumerate((w[1:] / scale).tolist()):
        odds = odds + F.col("x")[i] * k
    odds = F.least(F.greatest(odds, F.lit(-MOST)), F.lit(MOST))
    rows = rows.select("rid", "doc_id", "host", "path", "label", (1 / (1 + F.exp(-odds))).alias("doc_quality"))
    rows = landed(rows.withColumn("own", F.coalesce("label", "doc_quality")), "evidence")
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("s"))
    paths = landed(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    by_host, by_path = _strength(hosts, prior), _strength(paths, prior)
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("hn"), F.col("s").alias("hs"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).select(F.col("h"), F.col("path").alias("p"), "n", "s", "hn", "hs")
    joined = rows.join(paths, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    host_mean = (F.col("hs") - F.col("own") + by_host * prior) / (F.col("hn") - 1 + by_host)
    path_mean = (F.col("s") - F.col("own") + by_path * F.col("host_quality")) / (F.col("n") - 1 + by_path)
    scored = joined.withColumn("host_quality", host_mean).withColumn("path_quality", path_mean)
    combined = _odds(F.col("doc_quality")) - _odds(F.lit(prior)) + _odds(F.col("path_quality"))
    return scored.select("doc_id", "doc_quality", "host_quality", "path_quality", (1 / (1 + F.exp(-combined))).alias("score"))
