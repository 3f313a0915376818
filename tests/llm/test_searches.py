"""Exact top-k and nearest neighbours against brute force."""

import math
import random

from retenta.llm import ann, topk


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, every, k, score, fine):
    known = {}
    for i, v in rows:
        if i is not None and usable(v) and fine(v) and (i not in known or v < known[i]):
            known[i] = v
    out = []
    for q in (i for i in known if i % every == 0):
        best = sorted((-score(known[q], v), i) for i, v in known.items() if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def inner(a, b):
    return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b, strict=False))


def cosine(a, b):
    n = max(len(a), len(b))
    a, b = [list(map(float, x)) + [0.0] * (n - len(x)) for x in (a, b)]
    dot = aa = bb = 0.0
    for x, y in zip(a, b, strict=True):
        dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
    return max(-1.0, min(1.0, dot / math.sqrt(aa * bb)))


def table(n, width, seed):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(width)]) for i in range(n)]
    rows += [(n + i, list(rows[7][1])) for i in range(30)]  # ties
    rows += [(n + 50, None), (n + 51, [None] * width), (n + 52, [float("nan")] * width), (n + 53, [float("inf")] * width),
             (n + 54, [0.0] * width), (n + 55, [1.0, -2.0]), (-100, rows[3][1]), (None, rows[3][1]), (3, rows[3][1]), (n + 60, [])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1) for i, v in rows], "vec_id long, embedding array<double>, label string, score int").repartition(5)


def test_top_k(spark, monkeypatch):
    rows = table(700, 16, 1)
    assert rows_of(topk.top_k(frame(spark, rows))) == brute(rows, 100, 10, inner, lambda v: True)


def test_top_k_beyond_doubles(spark):
    rows = [(i, [(-1) ** i * 2.0 ** 18 * (i + 1), 3.0]) for i in range(8)]
    assert rows_of(topk.top_k(frame(spark, rows), every=4, k=3)) == brute(rows, 4, 3, inner, lambda v: True)


def test_pruning_skips_blocks(monkeypatch):
    import numpy as np
    seen = []
    monkeypatch.setattr(topk, "_product", lambda q, m: seen.append(len(q)) or (q @ m.T).astype(np.int64))
    blocks = [(np.arange(b * 10, b * 10 + 10), np.full((10, 4), 5.0 - b)) for b in range(5)]
    topk.search(3)([(np.array([1000]), np.ones((1, 4)))], blocks)
    assert sum(seen) == 1


def test_nearest(spark):
    rows = table(700, 16, 2)
    got, want = rows_of(ann.nearest(frame(spark, rows))), brute(rows, 50, 5, cosine, any)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert max(abs(a[3] - b[3]) for a, b in zip(got, want, strict=True)) < 1e-12


def test_nearest_of_extreme_lengths(spark):
    rows = [(i, [x * 10.0 ** (60 * (i % 3 - 1)) for x in v]) for i, v in table(120, 8, 3)[:120]]
    got, want = rows_of(ann.nearest(frame(spark, rows), every=10)), brute(rows, 10, 5, cosine, any)
    assert [r[:3] for r in got] == [r[:3] for r in want]


def test_fewer_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0])]
    assert [r[:3] for r in rows_of(ann.nearest(frame(spark, rows)))] == [(0, 1, 1)]
    assert rows_of(topk.top_k(frame(spark, rows))) == [(0, 1, 1, inner([1, 2], [2, 1]))]
    empty = frame(spark, rows).limit(0)
    assert rows_of(ann.nearest(empty)) == [] and rows_of(topk.top_k(empty)) == []
