"""Exact top-k by integer inner product, with block-at-a-time pruning.

Components become floor(1024 * x). A block's bound for a query is the sum, over components,
of the query's weight times the block's largest value there (the smallest, for a negative
weight). Each query visits its blocks in falling order of bound, scores a whole block through
its matrix (the forward index) and stops at the first block whose bound is below its
k-th score; a bound equal to it still counts, for the smaller vec_id.

Scores are sums in doubles while every partial sum is below 2**53 and in Python's whole
numbers beyond; both are exact. Scores beyond the range of long are cut to it.

Edge cases, beside those of ``blocks``: an empty vector scores 0 with all; with fewer
than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from retenta.llm.blocks import Best, block_table, tiles, widened

K = 10
EVERY = 100
SCALE = 1024
_LONG = (1 << 63) - 1


def _product(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    if np.abs(q).sum(axis=1).max(initial=0) * np.abs(m).max(initial=0) < 1 << 53:
        return (q @ m.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    out = whole(q).dot(whole(m).T) if q.shape[1] else np.zeros((len(q), len(m)), object)
    return np.array([[max(-_LONG - 1, min(_LONG, v)) for v in row] for row in out], np.int64).reshape(len(q), len(m))


def search(k: int):
    def run(queries: list, blocks: list) -> tuple:
        width = max(m.shape[1] for _, m in queries + blocks)
        ids = np.concatenate([i for i, _ in queries])
        q = np.floor(SCALE * widened([m for _, m in queries], width))
        forward = [(i, np.floor(SCALE * widened([m], width))) for i, m in blocks]
        high = np.array([m.max(axis=0) for _, m in forward])
        low = np.array([m.min(axis=0) for _, m in forward])
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        slack = 1e-9 * (np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T)  # of sums beyond 2**53
        bounds += np.where(slack > 1e-9 * (1 << 53), slack, 0)
        order = np.argsort(-bounds, axis=1, kind="stable")
        best, live = Best(ids, k), np.arange(len(ids))
        for place in range(len(forward)):
            b = order[live, place]
            live = live[bounds[live, b] >= best.bound[live]]
            if not len(live):
                break
            for block in np.unique(order[live, place]):
                rows = live[order[live, place] == block]
                vec_ids, m = forward[block]
                scores = _product(q[rows], m)
                for row, s in zip(rows, scores, strict=True):
                    good = np.flatnonzero(s >= best.bound[row])
                    if len(good) > k + 1:  # the block's own k + 1 best, least vec_id first
                        good = good[np.lexsort((vec_ids[good], -s[good]))[:k + 1]]
                    if len(good):
                        best.offer(row, s[good].tolist(), vec_ids[good].tolist())
        return best.rows()
    return run


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    return tiles(block_table(vectors), every, k, search(k), "long")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
