"""Exact and near-duplicate groups, shards: against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from linkledger.llm import components, exactdedup, sharding, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_groups(docs, rows, empty):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    got = exactdedup.exact_groups(docs).collect()
    assert len(got) == len(rows)
    want = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[(i, max(known, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((g.doc_id, g.keep_id, g.group_size, g.text_sha256) for g in got) == want
    kept = [g for g in got if g.kept]
    assert len({g.text_sha256 for g in kept}) == len(kept) == len(groups)
    assert all(g.doc_id == g.keep_id for g in kept)
    assert exactdedup.exact_groups(empty).collect() == []


def test_exact_dedup_settles_heavy_digests_without_python_or_shuffle(docs):
    plan = exactdedup.exact_groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan


def test_shards_are_minimax_and_gapless(docs, rows, empty):
    got = sharding.shard_documents(docs, 12).collect()
    assert Counter((g.doc_id, g["size"], g.text_crc32) for g in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    shards, groups = defaultdict(list), defaultdict(set)
    for g in got:
        shards[g.shard].append(g)
        groups[(g.text_crc32, g["size"])].add(g.shard)
    assert all(sorted(g.slot for g in s) == list(range(len(s))) for s in shards.values())
    assert all(len(s) == 1 for s in groups.values()) and set(shards) <= set(range(12))
    sizes = Counter()
    for r in rows:
        sizes[hashlib.sha256((r[1] or "").encode()).hexdigest()] += len((r[1] or "").encode()) + 16
    best = _capacity([sizes[k] for k in sorted(sizes)], 12)
    assert max(sum(g["size"] for g in s) for s in shards.values()) <= best
    assert sharding.shard_documents(empty, 12).collect() == []


def _capacity(sizes, k):
    def shards(c):
        n, used = 1, 0
        for x in sizes:
            if used + x > c:
                n, used = n + 1, 0
            used += x
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        m = (low + high) // 2
        low, high = (low, m) if shards(m) <= k else (m + 1, high)
    return low


def test_capacity_search_over_coarse_blocks():
    rng = random.Random(3)
    for _ in range(150):
        sizes = [16 + int(rng.expovariate(1 / 200)) if rng.random() < 0.97 else 20000 for _ in range(rng.randint(1, 300))]
        k, at = rng.randint(1, 40), np.cumsum(sizes).tolist()
        cut = sorted({*rng.sample(range(len(sizes)), min(rng.randint(1, 20), len(sizes))), len(sizes) - 1})
        ends = sharding.Ends([(at[i], i - p) for i, p in zip(cut, [-1, *cut], strict=False)])

        def refine(blocks, ends=ends, at=at):
            assert blocks
            finer = {}
            for a, b in blocks:
                inside = [e for e in at if a < e <= b]
                finer[(a, b)] = [(inside[0], 1)] + ([(inside[-1], len(inside) - 1)] if len(inside) > 1 else [])
            ends.divide(finer)

        c = sharding.smallest_capacity(ends, k, max(sizes), refine)
        assert c == _capacity(sizes, k)
        full = [0, *sharding.cuts_within(ends, c, k, refine), at[-1]]
        assert all(0 <= b - a <= c for a, b in zip(full, full[1:], strict=False)) and set(full) <= {0, *at}


def _near(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    p = np.array(prints, dtype=np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p[i] ^ p[i + 1 :]) <= 3).tolist():
            a, b = find(i), find(i + 1 + j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(p))]


def test_near_groups(docs, rows, empty):
    roots = _near([simhash.fingerprint(r[1]) for r in rows])
    least = defaultdict(list)
    for r, root in zip(rows, roots, strict=True):
        least[root].append(r[0])
    want = Counter((r[0], f"{simhash.fingerprint(r[1]):016x}", min((i for i in least[root] if i is not None), default=None)) for r, root in zip(rows, roots, strict=True))
    assert Counter(tuple(g) for g in simhash.near_groups(docs).collect()) == want
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert simhash.near_groups(empty).collect() == [] and simhash.without_near_copies(empty).collect() == []


def test_fingerprint_definition():
    import xxhash

    for text in [None, "", " \t", "One", "one TWO", "a b c", "a b c a b c d Ä ä\x0bz"]:
        words = [w.translate(LOWER) for w in (text or "").split()]
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("codes", [simhash.CODES, (*simhash.CODES, simhash.HAMMING)])
def test_anchors_cover_three_flips(codes):
    rng = np.random.default_rng(1)
    p = rng.integers(0, 2**63, 200, dtype=np.uint64)
    q = p.copy()
    for i in range(len(q)):
        for b in rng.choice(64, 3, replace=False):
            q[i] ^= np.uint64(1) << np.uint64(b)
    of = []
    for x in (p, q):
        sets = [set() for _ in x]
        for row, anchor in simhash.anchors(x, codes):
            for i, a in zip(row.tolist(), anchor.tolist(), strict=True):
                sets[i].add(a)
        of.append(sets)
    assert all(a & b for a, b in zip(*of, strict=True))


@pytest.mark.parametrize("crowd", [1024, 40, 5])
def test_links_of_crowded_anchors(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(9)
    centre, prints = rng.getrandbits(64), set()
    for _ in range(300):
        x = centre
        for _ in range(rng.randint(0, 9)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    order = sorted(prints)
    signed = np.array(order, dtype=np.uint64).view(np.int64).tolist()
    batches = _run(simhash._replicate(simhash.CODES), {"print": signed})
    rows = sorted(zip(*batches, strict=True))
    found = _run(simhash._compare, {"anchor": [r[0] for r in rows], "print": [r[1] for r in rows]}, size=37)
    edges = {(a, b) for a, b in zip(*found, strict=True) if a != b}
    crowded = sorted({a for a, b in zip(*found, strict=True) if a == b})
    assert bool(crowded) == (crowd < 100)
    if crowded:
        points = sorted(zip(*_run(simhash._ball, {"print": crowded}), strict=True))
        edges |= set(zip(*_run(simhash._hubs, dict(zip(("point", "far", "print"), zip(*points, strict=True), strict=True)), size=53), strict=True))
    roots = _near(order)
    assert all(roots[signed.index(a)] == roots[signed.index(b)] for a, b in edges)
    got = components.connected_components(spark.createDataFrame(sorted(edges) or [(0, 0)], "a long, b long"))
    labels = {r.node: r.root for r in got.collect()}
    by_root, by_label = defaultdict(set), defaultdict(set)
    for i, s in enumerate(signed):
        by_root[roots[i]].add(s)
        by_label[labels.get(s, s)].add(s)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_label.values()))


def _run(function, columns, size=1000):
    import pyarrow as pa

    kinds = {"far": pa.int8()}
    n = len(next(iter(columns.values())))
    batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + size], kinds.get(k, pa.int64())) for k, c in columns.items()], list(columns)) for i in range(0, n, size)]
    table = pa.Table.from_batches(list(function(iter(batches))))
    return [c.to_pylist() for c in table.columns]


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 1000 for i in range(1000, 1100)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
