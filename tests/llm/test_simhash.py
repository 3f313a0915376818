"""SimHash fingerprints, links and components against brute force."""

import random

import numpy as np
import xxhash

from retenta.llm import simhash
from retenta.llm.components import connected_components
from tests.llm.common import EDGES, edge_documents


def plain_fingerprint(text):
    words = [w for w in simhash._WORD.findall(text.lower())]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints():
    for t in ["", "a", "A b", "a b c", "The quick BROWN fox jumps", "é É x\x1cy z  w", "w " * 500]:
        assert simhash.fingerprint(t.encode()) == plain_fingerprint(t.encode())


def test_links_are_all_pairs_within_the_distance(spark):
    rnd = random.Random(5)
    fps = {0, 1, 7, 15, (1 << 64) - 1, (1 << 63)}
    for _ in range(150):
        base = rnd.getrandbits(64) if rnd.random() < 0.7 else rnd.getrandbits(32)
        fps.add(base)
        for _ in range(rnd.randint(0, 4)):
            x = base
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for parts in (2, 3):
        assert {(r.a, r.b) for r in simhash.links(df, 3, parts).collect()} == want


def test_thresholds_have_the_least_cost():
    rng = np.random.default_rng(2)
    costs = np.cumsum(rng.integers(0, 50, (40, 3, 5)), axis=2).astype(float)
    got = simhash.allocated(costs, 1)
    assert (got.sum(axis=1) == 1).all() and got.min() >= -1
    for c, t in zip(costs, got, strict=True):
        best = min(c[0, a + 1] + c[1, b + 1] + c[2, 1 - a - b + 1] for a in range(-1, 4) for b in range(-1, 4) if -1 <= 1 - a - b <= 3)
        assert c[np.arange(3), t + 1].sum() == best


def test_components(spark):
    rnd = random.Random(6)
    links = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)]
    want = components({x for p in links for x in p}, links)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(want[n] == r for n, r in got.items()) and all(n in got for p in links if p[0] != p[1] for n in p)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def check(rows, got):
    fp = [plain_fingerprint((t or "").encode()) for _, t in rows]
    linked = [(a, b) for a in set(fp) for b in set(fp) if (a ^ b).bit_count() <= 3]
    root = components(set(fp), linked)
    least = {}
    for (i, _), f in zip(rows, fp, strict=True):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted(((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fp, strict=True)), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_edge_rows(spark):
    docs = edge_documents(spark)
    check([r[:2] for r in EDGES], simhash.near_duplicates(docs).collect())
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == simhash.near_duplicates(docs).select("component_id").distinct().count()


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], simhash.near_duplicates(docs).collect())
