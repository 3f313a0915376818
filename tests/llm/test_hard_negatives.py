"""Hard negatives against brute force, and the bounds against exact scores."""

import math
import random

import numpy as np
import pytest

from retenta.llm import hard_negatives as hn
from tests.llm.test_searches import usable

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def score(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=False))


def brute(rows, every=100, positives=5, k=10):
    known = {}
    for i, v, label in rows:
        if i is not None and label is not None and usable(v):
            label = (label + 1) % 10 if i % 7 == 0 else label
            known[i] = min(known.get(i, (v, label)), (v, label))
    out = []
    for a, (v, label) in known.items():
        if a % every:
            continue
        near = sorted((-score(v, w), i) for i, (w, other) in known.items() if i != a and other == label)[:positives]
        for p, pid in near:
            hard = sorted((-s, i) for i, (w, other) in known.items()
                          if other != label and 30 * -p <= 100 * (s := score(v, w)) <= 90 * -p)[:k]
            out += [(a, pid, r, i, -p, -s) for r, (s, i) in enumerate(hard, 1)]
    return sorted(out)


def table(n, width, seed, labels=4):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0.3, 1) for _ in range(width)], rnd.randrange(labels)) for i in range(n)]
    rows += [(n + i, list(rows[7][1]), i % 3) for i in range(60)]  # ties
    return rows + [(n + 100, None, 1), (n + 101, [None] * width, 1), (n + 102, [float("nan")] * width, 1), (n + 103, [float("inf")] * width, 1),
                   (n + 104, rows[1][1], None), (None, rows[1][1], 1), (3, rows[5][1], 2), (3, rows[5][1], 2), (-700, rows[3][1], 9),
                   (-300, [1.0, -2.0], 0), (n + 105, [], 1), (n + 106, [0.0] * width, 2)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<double>, label int, n string, ids int").repartition(5)


def mined(spark, rows, **kw):
    return sorted(map(tuple, hn.mined(frame(spark, rows), **kw).select(*COLUMNS).collect()))


def test_matches_brute_force(spark):
    rows = table(900, 20, 1)
    want = brute(rows)
    assert mined(spark, rows) == want and len(want) > 200


def test_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 32)
    monkeypatch.setattr(hn, "GROUP", 100)
    monkeypatch.setattr(hn, "ANCHORS", 20)
    monkeypatch.setattr(hn, "STEP", 8)
    rows = table(500, 40, 2)
    assert mined(spark, rows, every=10) == brute(rows, every=10)


def test_one_label_holds_most_rows_and_all_are_alike(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(400)] + [(1000 + i, [0.5, 1.0, 1.0], 2) for i in range(40)]
    got = mined(spark, rows)
    assert got == brute(rows) and {r[1] for r in got if r[0] == 100} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [-1.0], 1), (2, [0.5], 2)], [(0, [0.0], 1), (1, [0.0], 1), (2, [5.0], 3)]])
def test_small_tables(spark, rows):
    assert mined(spark, rows) == brute(rows)


def test_beyond_doubles(spark):
    rows = [(100 * i, [(-1) ** i * 2.0 ** 21 * (i + 1), 2.0 ** 20 + i], i % 2) for i in range(6)]
    assert mined(spark, rows) == brute(rows)


def rows_of(data):
    return hn.Rows(np.arange(len(data)), np.zeros(len(data), np.int64), data)


@pytest.mark.parametrize("scale", [1.0, 1e200])
def test_bounds_never_drop_a_pair_in_reach(scale):
    rng = np.random.default_rng(3)
    q, x = (rows_of(np.floor(256 * (rng.normal(size=(n, 64)) + rng.normal(size=(n, 1))) * scale)) for n in (40, 300))
    s = q.data @ x.data.T if scale == 1 else np.full((40, 300), np.nan)
    least, most = np.full(40, np.quantile(s, 0.9) if scale == 1 else 1.0), np.full(40, np.quantile(s, 0.95) if scale == 1 else 2.0)
    with np.errstate(all="ignore"):
        row, col = hn.survivors(q, x, np.ones((40, 300), bool), least, most)
    left = np.zeros((40, 300), bool)
    left[row, col] = True
    if scale == 1:
        assert left[(s >= least[:, None]) & (s <= most[:, None])].all() and left.mean() < 0.6


def test_segments_with_means_drop_most_pairs():
    """Vectors that are nearly level in long segments: the first two levels decide."""
    rng = np.random.default_rng(4)
    data = np.floor(256 * (np.repeat(rng.normal(size=(400, 8)), 8, axis=1) + 0.01 * rng.normal(size=(400, 64))))
    q, x = rows_of(data[:20]), rows_of(data[20:])
    s = q.data @ x.data.T
    least = np.sort(s, axis=1)[:, -10]
    row, _ = hn.survivors(q, x, np.ones(s.shape, bool), least, np.full(20, np.inf))
    assert 200 <= len(row) < 0.05 * s.size
