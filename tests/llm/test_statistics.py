"""Statistics of languages, quality and mixes, beside plain counting."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import SCHEMA

from linkledger.llm import langid, mixing, quality
from pyspark.sql import functions as F


def counted(texts, langs, batches):
    rows = list(zip(langs, texts, strict=True))
    parts = [rows[i::batches] for i in range(batches)]
    made = (pa.RecordBatch.from_arrays([pa.array([r[0] for r in p]), pa.array([r[1] for r in p])], ["lang", "text"]) for p in parts)
    (out,) = langid._count(sorted(set(langs)))(made)
    return {(a, b): n for a, b, n in zip(*(c.to_pylist() for c in out.columns), strict=True)}


def test_counts_do_not_depend_on_windows_and_batches(monkeypatch):
    texts = ["abc " * 700, "x", "", "the quick brown fox " * 40, "zzz", "ab" * 900, "ü中é" * 50]
    langs = ["a", "b", "a", "a", "b", "b", "a"]
    want = Counter()
    for text, lang in zip(texts, langs, strict=True):
        chars, starts = langid._joined([text])
        times = Counter()
        for _, bucket in langid._buckets(chars, starts[1] - np.arange(len(chars))):
            times.update(bucket.tolist())
        for bucket, n in times.items():
            want["ab".index(lang), bucket] += round(1000 * math.log1p(n))
    for step in (1 << 17, 1000, 64):
        monkeypatch.setattr(langid, "AT_ONCE", step)
        for batches in (1, 3):
            assert counted(texts, langs, batches) == want


def test_a_group_of_copies_gives_its_share_of_training_rows(spark):
    rows = [(i, "copy of one text", "en") for i in range(3000)] + [(5000 + i, f"other {i}", "en") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    plain = langid.Model
    try:
        langid.Model = lambda names, sums, n: seen.append(sums.sum()) or plain(names, sums, n)
        langid.train(df, per_language=400)
        langid.train(df, per_language=10**9)
    finally:
        langid.Model = plain
    assert 0.05 < seen[0] / seen[1] < 0.15


def test_unlearnt_scripts_fit_nothing(docs, spark):
    model = langid.train(docs)
    texts = ["the of and to in that", "der die und in den von", "MIT licence", "这是一个完全不同的语言文字", "Это совсем другой язык", "这", "12", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in df.select("doc_id", langid.predict(df, model).alias("p")).select("doc_id", "p.*").collect()}
    assert all(got[i].fit >= langid.LEAST_FIT for i in (0, 1, 2)) and all(got[i].fit < langid.LEAST_FIT for i in (3, 4, 5))
    assert got[6].fit is None and got[7].lang_pred == "und"


def taken_by_brute_force(rows, block_words, seed):
    """rows: (rid, doc_id, source, size, order_key)."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[2]].append(r)
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    goals = mixing.targets([sum(r[3] for r in sources[s]) for s in order])
    taken = Counter()
    for rank, (source, goal) in enumerate(zip(order, goals, strict=True)):
        stream = []
        for rid, _, _, size, _ in sorted(sources[source], key=lambda r: (r[4] % mixing.PARTS, r[4], r[1] is not None, r[1] or 0, r[0])):
            stream += [rid] * size
        n, left, j = -(-len(stream) // block_words), int(goal + 0.5), 0
        while left:
            at, key = j % n, (rank * (mixing.AT_MOST + 1) + j // n) * 0xD1342543DE82EF95 % 2**64
            block = n - 1
            if at < n - 1:
                block = int(mixing.permuted(np.array([at]), np.array([n - 1]), np.array([(key + seed) % 2**64], dtype=np.uint64))[0])
            words = stream[block * block_words : (block + 1) * block_words][:left]
            taken.update(words)
            left, j = left - len(words), j + 1
    return taken, dict(zip(order, goals, strict=True))


@pytest.mark.parametrize("block_words", [8, 256, 100_000])
def test_taken_words_of_every_document(docs, rows, block_words):
    sized = mixing._sized(docs, mixing.SEED).collect()
    want, goals = taken_by_brute_force([(r.rid, r.doc_id, r.source, r.size, r.order_key) for r in sized], block_words, mixing.SEED)
    by_doc = Counter()
    for r in sized:
        by_doc[r.doc_id, r.size, want[r.rid]] += 1
    got = mixing.mix(docs, block_words=block_words)
    found = got.collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in found) == by_doc
    assert all(r.taken <= 2 * r.size for r in found)
    assert sum(r.taken for r in found) == sum(int(g + 0.5) for g in goals.values())


def test_small_sources_meet_their_targets(spark):
    rows = [(i, "w " * 200, "en", f"s{i}", 1) for i in range(6)]
    docs = spark.createDataFrame([(*r, 1, True, "x", "x", "x") for r in rows], SCHEMA)
    got = mixing.mix(docs).collect()
    assert all(abs(r.taken - r.target) <= 1 for r in got)
    pieces = mixing.mixed_documents(docs).groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).collect()
    assert {r.doc_id: r.n for r in pieces} == {r.doc_id: r.taken for r in got}
    blocks = mixing.mixed_blocks(docs).groupBy("doc_id").agg(F.sum("words").alias("n")).collect()
    assert {r.doc_id: r.n for r in blocks} == {r.doc_id: r.taken for r in got}


def test_scores_by_brute_force(spark, docs, rows):
    labelled = [(r[0], float(i % 3 == 0)) for i, r in enumerate(rows) if r[0] is not None and i % 2 == 0]
    labels = spark.createDataFrame(labelled, "doc_id long, quality double")
    got = quality.score_documents(docs, labels, F.col("source"), F.col("lang")).collect()
    known = defaultdict(list)
    for i, y in labelled:
        known[i].append(y)
    known = {i: sum(v) / len(v) for i, v in known.items()}
    x = np.array([quality.features(r[1]) for r in rows])
    with_label = [k for k, r in enumerate(rows) if r[0] in known]
    w, mean, scale = quality.fit(x[with_label], np.array([known[rows[k][0]] for k in with_label]))
    prior = np.mean([known[rows[k][0]] for k in with_label])
    odds = np.clip(w[0] + ((x - mean) / scale) @ w[1:], -quality.MOST, quality.MOST)
    own_quality = 1 / (1 + np.exp(-odds))
    own = [known.get(r[0], q) if r[0] is not None else q for r, q in zip(rows, own_quality, strict=True)]

    def strength(sites):
        n, s = (np.array([v[i] for v in sites.values()], dtype=float) for i in (0, 1))
        v, total = prior * (1 - prior), n.sum()
        between = ((n * (s / n - prior) ** 2).sum() - (len(n) - 1) * v) / (total - (n * n).sum() / total)
        return float(np.clip(v / between - 1 if between > 0 else quality.STRENGTHS[1], *quality.STRENGTHS))

    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for r, o in zip(rows, own, strict=True):
        for site in (hosts[r[3]], paths[r[3], r[2]]):
            site[0] += 1
            site[1] += o
    by_host, by_path = strength(hosts), strength(paths)
    want = []
    for r, o, q in zip(rows, own, own_quality, strict=True):
        (hn, hs), (n, s) = hosts[r[3]], paths[r[3], r[2]]
        host = (hs - o + by_host * prior) / (hn - 1 + by_host)
        path = (s - o + by_path * host) / (n - 1 + by_path)
        logit = [math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6))) for p in (q, prior, path)]
        want.append((r[0] if r[0] is not None else -1, q, host, path, 1 / (1 + math.exp(-(logit[0] - logit[1] + logit[2])))))
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.doc_quality, r.host_quality, r.path_quality, r.score) for r in got)
    assert np.allclose(np.array(found), np.array(sorted(want)), atol=1e-6)
