"""SimHash near-duplicates by the generalised pigeonhole.

1. Fingerprints: each text's ASCII letters are lowered, its words cut to shingles, and bit i
   is set if over half of the shingles' XXH64 values have it. Only fingerprints travel.
2. Equal fingerprints are one node, so copies are never paired.
3. Bits that go together are grouped into ``PARTS`` partitions (from a 64 x 64 count of bits
   set together, over all fingerprints), because thresholds help where values are uneven.
4. For thresholds t_1 .. t_m with sum ``distance - m + 1`` two fingerprints within the distance
   are within t_i in some partition i. Each fingerprint chooses its own thresholds (-1: the
   partition is not probed) by dynamic programming on the estimated work: values probed plus
   expected candidates, from counts of 16-bit pieces of all fingerprints (a table of fixed
   size, 4 x 65,536). A partition in which its value is common thus gets a low threshold.
5. It probes every value within t_i; candidates come from a join on the value and are
   verified by ``bit_count``. A pair is found from each side, so one side suffices.
6. Links between fingerprints give components; every document gets its component's least doc_id.

With two 32-bit partitions candidates stay far below the documents up to billions of them.

Edge cases: null texts and texts without words have fingerprint zero, which links as any other;
fewer words than a shingle make one shingle; null doc_ids get a component but don't name
one, unless all its documents lack an id (then it is null); rows repeated in the input are
copies; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from retenta.llm.components import connected_components
from retenta.llm.frames import arrow_map, column, slabs, unwrapped, whole_rows
from retenta.session import materialize

SHINGLE = 3
DISTANCE = 3
PARTS = 2
PIECE = 16
SEED = 42
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_HASHES = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = _WORD.findall(text.lower())  # bytes.lower() changes A-Z only
    if not words:
        return 0
    size = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    ones, n = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    while part := [digest(s, SEED) for s in itertools.islice(shingles, _HASHES)]:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep, shingle: int = SHINGLE) -> DataFrame:
    """(keep, fp): fp is the fingerprint's 64 bits as a long."""
    rows = docs.select(keep.alias("keep"), column(docs, "text").alias("text"))

    def digest(batches):
        for part, texts in slabs(batches):
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("keep"), pa.array(fp)], ["keep", "fp"])

    return arrow_map(rows, digest, f"keep {rows.schema['keep'].dataType.simpleString()}, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((64, 64))
    for batch in batches:
        x = _bits(batch.column("fp").to_numpy(zero_copy_only=False)).astype(np.float32)
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.reshape(-1).astype(np.int64))], ["at", "n"])


def bit_order(fps: DataFrame, parts: int = PARTS) -> np.ndarray:
    """The 64 bits, part after part: each part starts at the freest bit most correlated with
    any and takes those most correlated with what it has."""
    n = fps.count()
    rows = arrow_map(fps.select("fp"), _together, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(4096)
    for r in rows:  # 4,096 rows
        both[r["at"]] = r["n"]
    both = both.reshape(64, 64) / max(n, 1)
    p = np.diag(both)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, order = list(range(64)), []
    for i in range(parts):
        size = 64 * (i + 1) // parts - len(order)
        part = [free.pop(int(np.argmax(corr[np.ix_(free, free)].max(axis=1))))]
        while len(part) < size:
            part.append(free.pop(int(np.argmax(corr[np.ix_(free, part)].sum(axis=1)))))
        order += part
    return np.array(order)


def _values(fp: np.ndarray, order: np.ndarray, edges: list[int]) -> list[np.ndarray]:
    """The fingerprints' bits in the given order, cut at the edges."""
    bits = _bits(fp)[:, order]
    return [bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a, dtype=np.int64)) for a, b in itertools.pairwise(edges)]


def _piece_edges(parts: int) -> list[list[int]]:
    """Each part's edges, cut into pieces of PIECE bits at most."""
    cuts = [64 * i // parts for i in range(parts + 1)]
    return [[*range(a, b, PIECE), b] for a, b in itertools.pairwise(cuts)]


def _rings(counts: np.ndarray, most: int) -> np.ndarray:
    """Row t: how many rows' values are exactly t bits from each value (a hypercube, bit by bit)."""
    rings = np.zeros((most + 1, len(counts)))
    rings[0] = counts
    values = np.arange(len(counts))
    for bit in range(len(counts).bit_length() - 1):
        near = rings[:, values ^ (1 << bit)]
        rings[1:] += near[:-1]
    return rings


def piece_counts(fps: DataFrame, order: np.ndarray, parts: int = PARTS) -> list[list[np.ndarray]]:
    """Counts of each piece's values over all fingerprints: at most 65,536 rows a piece."""
    edges = _piece_edges(parts)

    def pieces(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for i, e in enumerate(edges):
                for j, v in enumerate(_values(fp, order, e)):
                    value, n = np.unique(v, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), i * 64 + j)), pa.array(value), pa.array(n)],
                                                     ["piece", "value", "n"])

    rows = arrow_map(fps.select("fp"), pieces, "piece long, value long, n long")
    counts = [[np.zeros(1 << (b - a)) for a, b in itertools.pairwise(e)] for e in edges]
    for r in rows.groupBy("piece", "value").agg(F.sum("n").alias("n")).toPandas().itertuples():
        counts[r.piece // 64][r.piece % 64][r.value] = r.n
    return counts


def _masks(width: int, t: int) -> np.ndarray:
    """All values of ``width`` bits with t bits set."""
    return np.array([sum(1 << i for i in c) for c in itertools.combinations(range(width), t)], np.int64)


def allocated(costs: np.ndarray, total: int) -> np.ndarray:
    """costs[row, part, t + 1] for thresholds t = -1, 0, ..: the least-cost thresholds a row
    whose sum is ``total``, by dynamic programming over the parts."""
    rows, parts, choices = costs.shape
    low, high = -parts, total + parts
    best = np.full((rows, high - low + 1), np.inf)
    best[:, -low] = 0
    picks = []
    for i in range(parts):
        after, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int64)
        for t in range(-1, choices - 1):
            moved = np.full_like(best, np.inf)
            src = best[:, max(0, -t):best.shape[1] - max(0, t)]
            moved[:, max(0, t):max(0, t) + src.shape[1]] = src
            moved += costs[:, i, t + 1][:, None]
            better = moved < after
            after[better], pick[better] = moved[better], t
        best = after
        picks.append(pick)
    at, out = np.full(rows, total - low), np.zeros((rows, parts), np.int64)
    for i in reversed(range(parts)):
        out[:, i] = picks[i][np.arange(rows), at]
        at = at - out[:, i]
    return out


def _probes(order, parts, distance, rings, n):
    """Arrow function: each fingerprint's probes as (key, fp)."""
    edges = _piece_edges(parts)

    def probe(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1 << 14):
                batch = whole.slice(at, 1 << 14)
                fp = batch.column("fp").to_numpy(zero_copy_only=False)
                costs = np.zeros((len(fp), parts, distance + 2))
                full = []
                for i, e in enumerate(edges):
                    ball = np.zeros((len(fp), distance + 1))
                    ball[:, 0] = n
                    value = np.zeros(len(fp), np.int64)
                    for j, v in enumerate(_values(fp, order, e)):
                        share, ball_then = rings[i][j][:, v].T / max(n, 1), ball
                        ball = np.zeros_like(ball)
                        for t in range(distance + 1):
                            for s in range(t + 1):
                                ball[:, t] += ball_then[:, t - s] * share[:, s]
                        value |= v << (e[j] - e[0])
                    full.append(value)
                    sizes = np.cumsum([len(_masks(e[-1] - e[0], t)) for t in range(distance + 1)])
                    costs[:, i, 1:] = np.cumsum(ball, axis=1) + sizes
                thresholds = allocated(costs, distance - parts + 1)
                for i, e in enumerate(edges):
                    for t in range(distance + 1):
                        rows = np.flatnonzero(thresholds[:, i] >= t)
                        if len(rows):
                            key = full[i][rows][:, None] ^ _masks(e[-1] - e[0], t)
                            yield _keyed(i, key, np.repeat(fp[rows], key.shape[1]))

    return probe


def _keyed(part: int, values: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), part, np.int32)), pa.array(values.reshape(-1)), pa.array(fp)],
                                      ["part", "key", "fp"])


def links(fps: DataFrame, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """(a, b) for all pairs of the distinct fingerprints ``fps`` that differ in ``distance`` bits at most."""
    order, n = bit_order(fps, parts), fps.count()
    rings = [[_rings(c, distance) for c in part] for part in piece_counts(fps, order, parts)]
    edges = _piece_edges(parts)

    def index(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for i, e in enumerate(edges):
                yield _keyed(i, _values(fp, order, [e[0], e[-1]])[0], fp)

    schema = "part int, key long, fp long"
    probes = arrow_map(fps.select("fp"), _probes(order, parts, distance, rings, n), schema).withColumnRenamed("fp", "a")
    stored = arrow_map(fps.select("fp"), index, schema).withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    found = probes.alias("p").join(stored.alias("s"), (F.col("p.part") == F.col("s.part")) & (F.col("p.key") == F.col("s.key"))
                                   & (F.col("a") < F.col("b")) & near)
    return found.select("a", "b")


def _labelled(fps: DataFrame, least, distance: int, parts: int) -> DataFrame:
    """(fp, label): ``least`` over all rows of the fingerprints reachable."""
    nodes = materialize(fps.groupBy("fp").agg(least.alias("least")), "simhash-nodes")
    roots = connected_components(links(nodes, distance, parts))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    lowest = named.groupBy("root").agg(F.min("least").alias("label"))
    return named.select("fp", "root").join(lowest, "root").select(F.col("fp").alias("of"), "label")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """Per document: doc_id, fingerprint, component_id."""
    fps = materialize(fingerprints(docs, column(docs, "doc_id"), shingle), "simhash")
    label = _labelled(fps, F.min("keep"), distance, parts)
    return fps.join(label, fps["fp"] == label["of"]).select(
        F.col("keep").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("label").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """The documents without near-duplicates: of each component the one of least doc_id (null
    last), then least text; whole rows. Decided by ids; then the kept rows are joined in."""
    key = F.struct(column(docs, "doc_id").isNull().alias("none"), column(docs, "doc_id").alias("id"),
                   F.xxhash64(F.coalesce(column(docs, "text"), F.lit(""))).alias("h"))
    fps = materialize(fingerprints(docs, key, shingle), "simhash")
    label = _labelled(fps, F.min("keep"), distance, parts)
    kept = label.select("label").distinct().select(F.col("label.id").alias("keep_id"), F.col("label.h").alias("keep_h"))
    rows = docs.select(whole_rows(docs).alias("row"), key.alias("key"))
    rows = rows.join(kept, F.col("key.id").eqNullSafe(F.col("keep_id")) & (F.col("key.h") == F.col("keep_h")))
    # rows of one doc_id and text are copies too; one of them stays
    if fps.groupBy("keep").count().where("count > 1").limit(1).count():
        rows = rows.dropDuplicates(["key"])
    return unwrapped(rows, "row", docs)
