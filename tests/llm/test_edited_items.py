"""Edited copies of test items, beside the alignment of every item with every text."""

import random

import numpy as np

from linkledger.llm import decontaminate as D


def _edited(rng, words, way):
    if way == "fourth":
        return [rng.choice(["lorem", "ipsum", w[::-1] + "q"]) if i % 4 == 3 else w for i, w in enumerate(words)]
    if way == "between":  # two words, then one more
        return [x for i, w in enumerate(words) for x in ([w, "lorem"] if i % 2 else [w])]
    out = []
    for w in words:
        out += rng.choice([["ipsum"], [], [w, "dolor"], [rng.choice(words)]]) if rng.random() < way else [w]
    return out


def test_hits_equal_alignment_of_all_items_with_all_texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and", "to"] * 60
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([8, 9, 15, 16, 31, 40, 59, 100])))) for k in range(60)]
    texts, copies = [], 0
    for _, text in items:
        for way in ("fourth", "between", 0.2, 0.25, 0.3):
            around = [rng.choices(vocabulary, k=rng.choice([0, 5, 300])) for _ in range(2)]
            texts.append(" ".join(around[0] + _edited(rng, text.split(), way) + around[1]))
    sought = D.Items(items)
    for text in texts:
        numbers, want = sought.numbers(text), {}
        for item_id, words in zip(sought.ids, sought.words, strict=True):
            score = D._best(words, numbers)[0]
            if score >= D.SCORE * D.MATCH * len(words) and score >= D.MATCH * D.MIN_WORDS:
                want[item_id] = score / (D.MATCH * len(words))
        assert {h["item_id"]: h["score"] for h in sought.hits(text)} == want
        copies += len(want)
    assert copies > 200


def test_copies_that_raise_the_counts_of_their_own_n_grams(spark):
    words = [f"w{i}" for i in range(40)]
    copy = " ".join(w if i % 4 != 3 else f"x{i}" for i, w in enumerate(words))
    docs = spark.createDataFrame([(1, copy), (2, " ".join(words)), (3, "w1 w2 w3")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: r.score for r in D.contaminated(docs, benchmark).collect()}
    assert got.keys() == {1, 2} and got[2] == 1.0 and np.isclose(got[1], (2 * 30 - 9) / 80)
