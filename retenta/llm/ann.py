"""Nearest neighbours by cosine: a block matrix join on int8 products.

Unit vectors are rounded to whole multiples of a step of their own (127 steps to the largest
component). A tile of int8 products, times both steps, is the cosine but for
``(1 + e_q) * e_x + e_q`` at most, where e is the length of a vector's rounding error. In each
tile a query's k-th best lower bound decides which pairs survive by their upper bound; these
are computed in double precision from the original vectors and merged in a k-best list. Every
vector is compared and no pair is dropped that could be among the best, so recall is 1.

The measure is dot / sqrt(q.q * x.x), sums in order of the components, cut to [-1, 1].
Vectors are scaled by a power of two first, so that neither squares nor sums overflow.

Edge cases, beside those of ``blocks``: zero and empty vectors take no part; with fewer than k
candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from retenta.llm.blocks import Best, block_table, tiles, widened

K = 5
EVERY = 50
STEPS = 127
#: Above the rounding of the float sums that bounds and products are made of.
SLACK = 1e-9


def _in_order(x: np.ndarray) -> np.ndarray:
    """Row sums, added from the first component to the last."""
    return np.add.accumulate(x, axis=1)[:, -1]


class Rounded:
    def __init__(self, vectors: np.ndarray):
        big = np.abs(vectors).max(axis=1)
        self.exact = np.ldexp(vectors, -np.frexp(big)[1][:, None])
        self.squares = _in_order(self.exact * self.exact)
        unit = self.exact / np.sqrt(self.squares)[:, None]
        self.step = np.abs(unit).max(axis=1) / STEPS
        self.codes = np.rint(unit / self.step[:, None]).astype(np.int8)
        self.error = np.linalg.norm(unit - self.codes * self.step[:, None], axis=1) + SLACK

    def wide(self) -> np.ndarray:
        """Codes in floats that hold every sum of products exactly."""
        return self.codes.astype(np.float32 if self.codes.shape[1] * STEPS * STEPS < 1 << 24 else np.float64)


def cosines(q: np.ndarray, q2: np.ndarray, x: np.ndarray, x2: np.ndarray) -> np.ndarray:
    return np.clip(_in_order(q * x) / np.sqrt(q2 * x2), -1.0, 1.0)


def search(k: int):
    def run(queries: list, blocks: list) -> tuple:
        width = max(m.shape[1] for _, m in queries + blocks)
        ids = np.concatenate([i for i, _ in queries])
        q = Rounded(widened([m for _, m in queries], width))
        q_codes, best = q.wide(), Best(ids, k)
        floor = np.full(len(ids), -np.inf)  # of the k-th best by lower bound so far
        held = np.full((len(ids), k), -np.inf)
        tile = [blocks[i:i + 4] for i in range(0, len(blocks), 4)]
        for part in tile:
            vec_ids = np.concatenate([i for i, _ in part])
            x = Rounded(widened([m for _, m in part], width))
            near = (q_codes @ x.wide().T).astype(float) * q.step[:, None] * x.step
            slack = (1 + q.error)[:, None] * x.error + q.error[:, None]
            near[ids[:, None] == vec_ids] = -np.inf
            top = np.concatenate((held, near - slack), axis=1)
            held = -np.partition(-top, k - 1, axis=1)[:, :k]
            floor = held.min(axis=1)
            row, col = np.nonzero((near + slack >= floor[:, None]) & (near > -np.inf))
            for at in range(0, len(row), 1 << 16):
                r, c = row[at:at + (1 << 16)], col[at:at + (1 << 16)]
                s = cosines(q.exact[r], q.squares[r], x.exact[c], x.squares[c])
                edge = np.append(np.flatnonzero(np.diff(r, prepend=-1)), len(r))
                for a, b in zip(edge[:-1], edge[1:], strict=True):
                    best.offer(int(r[a]), s[a:b].tolist(), vec_ids[c[a:b]].tolist())
        return best.rows()
    return run


def nearest(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    blocks = block_table(vectors, lambda v: F.exists(v, lambda x: x != 0))
    return tiles(blocks, every, k, search(k), "double")


SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_cosine_similarity(q.v, x.v) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
