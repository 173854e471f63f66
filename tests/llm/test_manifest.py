"""Manifest against brute force: nulls, repeated ids and rows, deep trees, blocks of the directory."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from llm_data import SCHEMA
from test_groups import LOWER

from linkledger.llm import manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and of each node its siblings (left, right) level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            run = i // 16 * 16
            path.append(("".join(level[run:i]), "".join(level[i + 1 : run + 16])))
        level = [h("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        at = [i // 16 for i in at]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        changed = leaf((doc_id, source, lang, n_chars, text and text.translate(LOWER)))
        tampered = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        own = leaf((doc_id, source, lang, n_chars, text))
        groups[source].append((doc_id is not None, doc_id or 0, own, changed if tampered else own, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = tree([r[2] for r in groups[name]])
    root, above = tree([trees[n][0] for n in names])
    out = []
    for name, up in zip(names, above, strict=True):
        subroot, paths = trees[name]
        for (_, _, own, folded, doc_id), path in zip(groups[name], paths, strict=True):
            proof = h("".join(a + b for a, b in path + up))
            for a, b in path + up:
                folded = h(a + folded + b)
            out.append((doc_id, own, subroot, root, proof, folded, folded == root))
    return out


def made(docs):
    got = manifest.manifest(docs, manifest.lower_cased(docs))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in got.collect())


def test_manifest(docs, rows, empty):
    got = made(docs)
    assert got == Counter(brute([r[:5] for r in rows]))
    assert any(not r[6] for r in got) and any(r[6] for r in got)
    assert made(empty) == Counter()


@pytest.mark.parametrize("ids", [range(4200), [*range(-40, 40), 1 << 40, -(1 << 62), (1 << 62) + 5, 7, 7, 7, None, None]])
def test_deep_and_wide_trees(spark, ids):
    rows = [(i, f"Text {k % 9}", None if k % 5 else "en", None if k % 97 == 3 else "all", k % 9) for k, i in enumerate(ids)]
    docs = spark.createDataFrame([(*r, 1, True, "x", "x", "x") for r in rows], SCHEMA).repartition(6)
    assert made(docs) == Counter(brute(rows))


def test_many_sources(spark):
    rows = [(i, "A b", "en", f"é{i % 300}" if i % 11 else "", i) for i in range(600)]
    docs = spark.createDataFrame([(*r, 1, True, "x", "x", "x") for r in rows], SCHEMA).repartition(6)
    assert made(docs) == Counter(brute(rows))


def test_one_document(spark):
    rows = [(5, None, None, None, None)]
    docs = spark.createDataFrame([(*r, 1, True, "x", "x", "x") for r in rows], SCHEMA)
    (got,) = made(docs)
    assert got[1] == got[2] == got[3] == got[5] and got[4] == h("") and got[6]
