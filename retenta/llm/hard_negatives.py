"""Hard negatives by segment summaries.

Vectors, their components made whole numbers, lie in blocks of one table row each: ids, labels, the
matrix, and for each of ``LEVELS`` a summary: every segment's mean and its deviation from it, both
times the root of the segment's length. For two vectors the products of means, plus or minus the
products of deviations, bound the inner product from both sides (Cauchy-Schwarz, segment by segment).

A block meets a group of anchors: bounds of the longest segments are looked at for all pairs, those
of the shorter segments for the pairs that are left, and what is left then is scored exactly. A
pair is dropped as soon as its upper bound falls below what it must reach, or its lower bound
exceeds what it may have. What it must reach rises with each block: the k-th score that the anchor
(or the anchor and positive) already has. So nothing that could be returned is dropped.

1. Positives: each anchor's first ``positives`` other rows of its label.
2. Negatives: for each anchor and positive, the first ``k`` rows of other labels with a score
   between ``low`` and ``high`` hundredths of the positive's.

Anchors are a stated share of the rows, met with all rows in tiles of about ``GROUP`` rows and
``ANCHORS`` anchors; each tile hands on its best few, which a window merges. An anchor's positives
travel with it to the second step.

Scores are sums in doubles while every partial sum is below 2**53 and in Python's whole numbers
beyond; beyond the range of long they are cut to it.

On vectors without structure (independent components) long segments bound little: there only
pairs of components drop pairs (README has the shares).

Edge cases: rows with a null id, label or vector, or with null or non-finite components take no
part. Rows repeating a vec_id count once: the least vector, then the least label. Shorter vectors
are filled up with zeros; an empty vector scores 0 with all. Ties go to the smaller vec_id. An
anchor without another row of its label gives no rows; a negative positive score leaves no room
between the limits, so it gives none either. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from retenta.llm.frames import arrow_map, column, partitions
from retenta.session import materialize

SCALE = 256
EVERY = 100
POSITIVES = 5
K = 10
LOW, HIGH = 30, 90
#: Segment lengths, longest first.
LEVELS = (32, 8, 2)
ROWS = 1024
GROUP = 16_384
ANCHORS = 8192
#: Above the rounding of summaries, which are kept in 4 bytes, and of the sums made of them.
SLACK = 1e-6
#: Anchors looked at together.
STEP = 1024
BLOCK = "n int, width int, ids binary, labels binary, data binary, summary binary"
_LONG = (1 << 63) - 1


def summary(data: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level (means, deviations), one column a segment, both times the root of its length."""
    out = []
    for length in LEVELS:
        parts = data.reshape(len(data), -1, length)
        mean = parts.mean(axis=2)
        out.append((mean * math.sqrt(length), np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))))
    return out


class Rows:
    """Ids, labels, whole-number components and summaries of some rows."""

    def __init__(self, ids, labels, data, levels=None):
        self.ids, self.labels, self.data = ids, labels, data
        self.levels = levels or summary(data)
        self.length = np.linalg.norm(data, axis=1)

    @classmethod
    def of(cls, row: dict, width: int) -> Rows:
        n, own = row["n"], row["width"]
        data = np.frombuffer(row["data"], "<f8").reshape(n, own)
        levels, at = [], 0
        flat = np.frombuffer(row["summary"], "<f4").astype(float)
        for length in LEVELS:
            segments = own // length
            pair = []
            for _ in range(2):
                part = flat[at:at + n * segments].reshape(n, segments)
                pair.append(np.pad(part, ((0, 0), (0, width // length - segments))))
                at += n * segments
            levels.append(tuple(pair))
        return cls(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"),
                   np.pad(data, ((0, 0), (0, width - own))), levels)

    def part(self, a: int, b: int) -> Rows:
        return Rows(self.ids[a:b], self.labels[a:b], self.data[a:b], [(m[a:b], d[a:b]) for m, d in self.levels])


def _block(ids: list[int], labels: list[int], vectors: list[np.ndarray]) -> pa.RecordBatch:
    width = -(-max([1, *map(len, vectors)]) // LEVELS[0]) * LEVELS[0]
    data = np.zeros((len(vectors), width))
    for row, v in zip(data, vectors, strict=True):
        row[:len(v)] = np.floor(SCALE * v)
    with np.errstate(over="ignore"):
        flat = b"".join(x.astype("<f4").tobytes() for level in summary(data) for x in level)
    return pa.RecordBatch.from_pydict({
        "n": pa.array([len(ids)], pa.int32()), "width": pa.array([width], pa.int32()),
        "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), "labels": pa.array([np.array(labels, "<i8").tobytes()], pa.binary()),
        "data": pa.array([data.astype("<f8").tobytes()], pa.binary()), "summary": pa.array([flat], pa.binary())})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, labels, vectors, last = [], [], [], None
    for batch in batches:
        lists = batch.column("v")
        for i, (vec_id, label) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
            if vec_id == last:
                continue
            last = vec_id
            ids.append(vec_id)
            labels.append(label)
            vectors.append(lists[i].values.to_numpy(zero_copy_only=False).astype(float))
            if len(ids) == ROWS:
                yield _block(ids, labels, vectors)
                ids, labels, vectors = [], [], []
    if ids:
        yield _block(ids, labels, vectors)


def relabelled(vec_id: Column, label: Column) -> Column:
    """Every seventh id's label is moved on by one."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def block_table(vectors: DataFrame) -> DataFrame:
    vec_id, label, v = (column(vectors, c) for c in ("vec_id", "label", "embedding"))
    rows = vectors.select(vec_id.cast("long").alias("vec_id"), relabelled(vec_id.cast("long"), label.cast("long")).alias("label"),
                          v.cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine)
    rows = rows.repartitionByRange(partitions(vectors.sparkSession), "vec_id").sortWithinPartitions("vec_id", "v", "label")
    return materialize(arrow_map(rows, _blocks, BLOCK), "negative-blocks")


def survivors(q: Rows, x: Rows, alive: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in q and x) of ``alive`` whose bounds leave room between the anchors'
    ``least`` and ``most``."""
    row, col = np.nonzero(alive)
    for (qm, qd), (xm, xd) in zip(q.levels, x.levels, strict=True):
        if not len(row):
            break
        slack = SLACK * q.length[row] * x.length[col] + SLACK
        if 8 * len(row) > alive.size:
            near, wide = (qm @ xm.T)[row, col], (qd @ xd.T)[row, col] + slack
        else:
            near, wide = (np.concatenate([np.einsum("ij,ij->i", a[row[i:i + STEP * 16]], b[col[i:i + STEP * 16]])
                                          for i in range(0, len(row), STEP * 16)]) for a, b in ((qm, xm), (qd, xd)))
            wide = wide + slack
        wide = np.where(np.isfinite(near) & np.isfinite(wide), wide, np.inf)  # a product out of range bounds nothing
        near = np.where(np.isfinite(near), near, 0)
        left = (near + wide >= least[row]) & (near - wide <= most[row])
        row, col = row[left], col[left]
    return row, col


def exact(q: Rows, x: Rows, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    if np.abs(q.data).sum(axis=1).max(initial=0) * np.abs(x.data).max(initial=0) < 1 << 53:
        parts = [np.einsum("ij,ij->i", q.data[row[i:i + STEP * 16]], x.data[col[i:i + STEP * 16]]) for i in range(0, len(row), STEP * 16)]
        return np.concatenate([*parts, np.empty(0)]).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(q.data[r], x.data[c], strict=True)) for r, c in zip(row, col, strict=True)]
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in whole], np.int64)


class Best:
    """The first k rows (higher score, then smaller id) of each of n lists."""

    def __init__(self, n: int, k: int):
        self.k, self.reach = k, np.full(n, -np.inf)  # the k-th score, once there are k
        self.list, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def offer(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.reach[at]
        at, score, ids = (np.concatenate(p) for p in ((self.list, at[good]), (self.score, score[good]), (self.id, ids[good])))
        order = np.lexsort((ids, ~score, at))
        at, score, ids = at[order], score[order], ids[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < self.k
        last = place == self.k - 1
        self.reach[at[last]] = score[last]
        self.list, self.score, self.id = at[kept], score[kept], ids[kept]


def _floats(x: np.ndarray, up: bool) -> np.ndarray:
    """Longs as doubles that are not below (or not above) them."""
    return np.nextafter(x.astype(float), np.inf if up else -np.inf)


def positives_of(q: Rows, blocks: list[Rows], k: int) -> Best:
    best = Best(len(q.ids), k)
    for x in blocks:
        alive = (q.labels[:, None] == x.labels) & (q.ids[:, None] != x.ids)
        row, col = survivors(q, x, alive, best.reach, np.full(len(q.ids), np.inf))
        best.offer(row, exact(q, x, row, col), x.ids[col])
    return best


def negatives_of(q: Rows, anchor: np.ndarray, positive_score: np.ndarray, blocks: list[Rows], k: int, low: int, high: int) -> Best:
    """``anchor``: for each (anchor, positive), in ascending order, the anchor's place in q."""
    least, most = limits(positive_score, low, high)
    best, first = Best(len(anchor), k), np.searchsorted(anchor, np.arange(len(q.ids) + 1))
    top = np.full(len(q.ids), -np.inf)
    np.maximum.at(top, anchor, _floats(most, True))
    for x in blocks:
        floor = np.full(len(q.ids), np.inf)
        np.minimum.at(floor, anchor, np.maximum(_floats(least, False), best.reach))
        row, col = survivors(q, x, (q.labels[:, None] != x.labels) & (top > -np.inf)[:, None], floor, top)
        score = exact(q, x, row, col)
        for j in range(int(np.diff(first).max(initial=0))):  # an anchor's j-th positive
            at = first[row] + j
            good = at < first[row + 1]
            good[good] = (score[good] >= least[at[good]]) & (score[good] <= most[at[good]])
            best.offer(at[good], score[good], x.ids[col[good]])
    return best


def limits(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the most s with low * score <= 100 * s <= high * score."""
    whole = [int(s) for s in score]
    return (np.array([-(-low * s // 100) for s in whole], np.int64), np.array([high * s // 100 for s in whole], np.int64))


def _anchors(every: int):
    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                data = np.frombuffer(row["data"], "<f8").reshape(row["n"], row["width"])
                labels = np.frombuffer(row["labels"], "<i8")
                mine = np.flatnonzero(ids % every == 0)
                if len(mine):
                    yield pa.RecordBatch.from_pydict({
                        "anchor_id": pa.array(ids[mine]), "label": pa.array(labels[mine]),
                        "data": pa.array([data[i].tobytes() for i in mine], pa.binary())})
    return pick


def _met(blocks: DataFrame, anchors: DataFrame, best, schema: str) -> DataFrame:
    """``best`` of each group of blocks and each group of anchors. It takes anchors and blocks as
    Rows, and the anchors' table rows."""
    rows, many = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], anchors.count()
    groups, askers = max(1, math.ceil(rows / GROUP)), max(1, math.ceil(many / ANCHORS))
    own = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.select(own(groups, "ids").alias("g"), each(askers).alias("a"), *blocks.columns)
    right = anchors.select(each(groups).alias("g"), own(askers, "anchor_id").alias("a"), *anchors.columns)
    names = [f.split()[0] for f in schema.split(", ")]

    def meet(found: pa.Table, asked: pa.Table) -> pa.Table:
        found, asked = found.to_pylist(), sorted(asked.to_pylist(), key=lambda r: r["anchor_id"])
        out: list[list] = [[] for _ in names]
        if found and asked:
            width = max([r["width"] for r in found] + [len(r["data"]) // 8 for r in asked])
            blocks = [Rows.of(r, width) for r in found]
            for i in range(0, len(asked), STEP):
                some = asked[i:i + STEP]
                data = np.zeros((len(some), width))
                for row, r in zip(data, some, strict=True):
                    row[:len(r["data"]) // 8] = np.frombuffer(r["data"], "<f8")
                q = Rows(np.array([r["anchor_id"] for r in some]), np.array([r["label"] for r in some]), data)
                for held, new in zip(out, best(q, blocks, some), strict=True):
                    held.extend(new.tolist())
        return pa.table([pa.array(x, pa.int64()) for x in out], names=names)

    return left.groupBy("g", "a").cogroup(right.groupBy("g", "a")).applyInArrow(meet, schema)


def _first(rows: DataFrame, by: list[str], score: str, vec_id: str, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), vec_id))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def mined(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, k: int = K, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    blocks = block_table(vectors)
    anchors = materialize(arrow_map(blocks, _anchors(every), "anchor_id long, label long, data binary"), "negative-anchors")

    def near(q: Rows, blocks: list[Rows], _) -> tuple:
        best = positives_of(q, blocks, positives)
        return q.ids[best.list], best.id, best.score

    found = _met(blocks, anchors, near, "anchor_id long, positive_id long, positive_score long")
    found = _first(found, ["anchor_id"], "positive_score", "positive_id", positives)
    held = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("own"))
    asking = materialize(anchors.join(held, "anchor_id"), "negative-asking")  # a few positives a row

    def hard(q: Rows, blocks: list[Rows], asked: list[dict]) -> tuple:
        anchor = np.array([i for i, r in enumerate(asked) for _ in r["own"]])
        positive, score = (np.array([p[c] for r in asked for p in r["own"]], np.int64) for c in ("positive_id", "positive_score"))
        best = negatives_of(q, anchor, score, blocks, k, low, high)
        return q.ids[anchor[best.list]], positive[best.list], best.id, score[best.list], best.score

    out = _met(blocks, asking, hard, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    out = _first(out, ["anchor_id", "positive_id"], "negative_score", "negative_id", k)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_dot_product(a.v, x.v)::BIGINT AS score
  FROM v a JOIN v x ON a.vec_id % 100 = 0 AND x.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""
