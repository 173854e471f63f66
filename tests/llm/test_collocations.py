"""Phrases against counting everything."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA

from linkledger.llm import collocations

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute(rows, top):
    grams, n = {}, Counter()
    for text, lang in rows:
        f = grams.setdefault(lang or "und", Counter())
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(UPPER)):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 30}
        inside = {q[i : i + k] for q, a in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * a >= 80 * f[q[i : i + k]]}
        found = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, b" ".join(p), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def texts(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"Wörd{i}" for i in range(60)]
    fixed = [[rng.choice(words) for _ in range(rng.randint(2, 6))] for _ in range(25)]
    rows = []
    for i in range(400):
        out = []
        while len(out) < rng.randint(5, 80):
            out += rng.choice(fixed) if rng.random() < 0.6 else [words[min(59, int(rng.expovariate(0.1)))]]
            if rng.random() < 0.15:
                out[-1] += rng.choice([".", ", ", "\n", "!\r\n", ";", "\t", " \t "])
        text = " ".join(out)
        rows.append((text.upper() if i % 7 == 0 else text, [None, "und", "en", "en", "de"][i % 5]))
    return rows + [(None, "en"), ("", None), (" . , ", "xx"), ("solo", "yy"), ("Ab\x00c d\x85e " * 40, "en")] + [rows[5]] * 60


@pytest.fixture(scope="module")
def some(spark):
    rows = texts()
    full = [(i, t, lang, "s", 1, 1, True, "x", "x", "x") for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(5).cache(), rows


@pytest.mark.parametrize("top, waves", [(2000, (0,)), (12, collocations.WAVES), (5, (900_000, 400_000, 150_000, 0))])
def test_phrases(some, top, waves):
    docs, rows = some
    want = brute(rows, top)
    assert made(collocations.phrases(docs, top, waves)) == want and len({w[0] for w in want}) > 1


def test_all_phrases_of_mixed_documents(docs, rows, empty):
    assert made(collocations.phrases(docs)) == brute([(r[1], r[2]) for r in rows], 2000)
    assert made(collocations.phrases(empty)) == []


def test_blocks_and_counts_come_in_bounded_pieces(spark):
    """Of blocks, megabytes each, few are in a file, as all of a file are read at once; counts are handed over in turn."""
    docs = spark.createDataFrame([("en", f"some words {i}") for i in range(9)], "lang string, text string").coalesce(1)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        blocks, words = collocations._split(docs)
    finally:
        spark.conf.set(setting, before)
    files = [r[0] for r in blocks.selectExpr("_metadata.file_path AS f").groupBy("f").count().select("count").collect()]
    assert sum(files) == 9 and max(files) <= collocations.PER_FILE
    assert words.where("word = 'some'").first().n == 9
    n = collocations.AT_ONCE + 5
    a, b = np.arange(n), np.arange(n) * 2
    parts = list(collocations._in_turn(a, b))
    assert [len(x) for x, _ in parts] == [n - 5, 5] and (np.concatenate([y for _, y in parts]) == b).all()
    assert not list(collocations._in_turn(a[:0], b[:0]))
