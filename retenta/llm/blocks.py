"""Vectors in blocks, and a stated set of query rows met with all blocks.

Vectors are range-partitioned by vec_id and cut to blocks of ``ROWS`` rows: one table row
holds a block's ids and matrix. ``tiles`` deals blocks to groups of about ``GROUP`` rows and
queries to groups of about ``QUERIES``; each pair of groups is one task's work, so neither
the rows nor the queries of a task grow with the table. The tasks' best rows (a few a query
and group) are merged by a window, which Spark limits before the shuffle too.

Vectors that are null or hold null or non-finite components, and rows without vec_id, take no
part. Vectors of different lengths are filled up with zeros. Rows repeating a vec_id count
once, the least vector of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retenta.llm.frames import arrow_map, column, partitions
from retenta.session import materialize

ROWS = 256
GROUP = 8192
QUERIES = 2048
BLOCK = "n int, width int, ids binary, data binary"


def _block(ids: np.ndarray, vectors: list[np.ndarray]) -> pa.RecordBatch:
    width = max(map(len, vectors))
    data = np.zeros((len(vectors), width))
    for row, v in zip(data, vectors, strict=True):
        row[:len(v)] = v
    return pa.RecordBatch.from_pydict({
        "n": pa.array([len(ids)], pa.int32()), "width": pa.array([width], pa.int32()),
        "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()), "data": pa.array([data.astype("<f8").tobytes()], pa.binary())})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list[int] = []
    vectors: list[np.ndarray] = []
    last = None
    for batch in batches:
        lists = batch.column("v")
        for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
            if vec_id == last:
                continue
            last = vec_id
            ids.append(vec_id)
            vectors.append(lists[i].values.to_numpy(zero_copy_only=False).astype(float))
            if len(ids) == ROWS:
                yield _block(np.array(ids), vectors)
                ids, vectors = [], []
    if ids:
        yield _block(np.array(ids), vectors)


def matrix(block) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["data"], "<f8").reshape(block["n"], block["width"])


def widened(parts: list[np.ndarray], width: int) -> np.ndarray:
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def block_table(vectors: DataFrame, usable=None) -> DataFrame:
    """One row a block. ``usable``: a further condition on the vector column."""
    v = column(vectors, "embedding")
    rows = vectors.select(column(vectors, "vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
    rows = rows.where(usable(F.col("v"))) if usable else rows
    rows = rows.repartitionByRange(partitions(vectors.sparkSession), "vec_id").sortWithinPartitions("vec_id", "v")
    return materialize(arrow_map(rows, _blocks, BLOCK), "vector-blocks")


def tiles(blocks: DataFrame, every: int, k: int, search: Callable[[list, list], tuple], score: str) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every`` its k
    best others. ``search`` takes query parts and blocks, each (ids, matrix), and returns query
    ids, vec ids and scores of the tile's best."""
    def queries(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, data = matrix(row)
                mine = ids % every == 0
                if mine.any():
                    yield _block(ids[mine], list(data[mine]))

    asked = materialize(arrow_map(blocks, queries, BLOCK), "vector-queries")
    rows, many = (t.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for t in (blocks, asked))
    groups, askers = max(1, math.ceil(rows / GROUP)), max(1, math.ceil(many / QUERIES))
    own = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.select(own(groups).alias("g"), each(askers).alias("a"), "n", "width", "ids", "data")
    right = asked.select(each(groups).alias("g"), own(askers).alias("a"), "n", "width", "ids", "data")

    def meet(found: pa.Table, wanted: pa.Table) -> pa.Table:
        parts = [[matrix(r) for r in t.select(["n", "width", "ids", "data"]).to_pylist()] for t in (wanted, found)]
        q, v, s = search(*parts) if parts[0] and parts[1] else ([], [], [])
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()),
                         "score": pa.array(s, pa.int64() if score == "long" else pa.float64())})

    best = left.groupBy("g", "a").cogroup(right.groupBy("g", "a")).applyInArrow(
        meet, f"query_id long, vec_id long, score {score}")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Best:
    """The k best (score, least vec_id first) of each query."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.kept: list[list[tuple]] = [[] for _ in query_ids]
        self.bound = np.full(len(query_ids), -np.inf)  # of the k-th, once there are k

    def offer(self, row: int, scores, vec_ids) -> None:
        own = self.query_ids[row]
        new = [(-s, v) for s, v in zip(scores, vec_ids, strict=True) if v != own]
        if new:
            self.kept[row] = sorted(self.kept[row] + new)[:self.k]
            if len(self.kept[row]) == self.k:
                self.bound[row] = -self.kept[row][-1][0]

    def rows(self) -> tuple[list, list, list]:
        flat = [(int(q), v, -s) for q, kept in zip(self.query_ids, self.kept, strict=True) for s, v in kept]
        return tuple(map(list, zip(*flat, strict=True))) if flat else ([], [], [])
