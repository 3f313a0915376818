"""Quality classifier: random-indexing word vectors, pooled per document, then a small network.

1. Word vectors. Each word falls into one of ``BUCKETS`` hash buckets and each bucket has a
   sparse random index vector. Over the whole corpus a bucket's context vector is the sum
   of the index vectors of the words within ``WINDOW`` places. A task sums its documents
   into one matrix of fixed size; the matrices are added in two rounds (salted, then one
   row a block), so what meets in a task doesn't follow the corpus.
2. Documents. Every text is pooled to its words' mean context vector, the mean similarity of
   neighbouring words (by context and by index vector) and the shares of word kinds.
3. Labels. The pooled vectors of at most ``MAX_LABELLED`` labelled documents (those with
   the smallest hash of doc_id) train the network on the driver; the bound is a parameter.
   The temperature is fitted on a fifth of them that the weights don't see.

Steps 1 and 2 take every document; only step 3 is a bounded sample.

Edge cases: null texts are empty; texts without words pool to zeros and get a score like any
other; null labels and labels without a document are left out; a doc_id labelled twice counts
with each label; with labels of one class, or none, the score is constant. Rows repeated in
the input are scored alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from retenta.llm import network
from retenta.llm.frames import arrow_map, column, slabs, unwrapped, whole_rows
from retenta.llm.words import Slab
from retenta.session import materialize

BUCKETS = 1 << 14
DIM = 64
NONZERO = 2
WINDOW = 2
BLOCK = 1 << 10
SALTS = 16
MAX_LABELLED = 20_000
FEATURES = DIM + 7
THRESHOLD = 0.3
#: Words whose vectors are looked up at once.
PIECE = 1 << 15


def index_vectors(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's nonzero entries."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def _buckets(slab: Slab) -> np.ndarray:
    return (slab.hashes() % np.uint64(BUCKETS)).astype(np.int64)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    total = np.zeros(BUCKETS * DIM)
    for _, texts in slabs(batches):
        slab = Slab(texts)
        w = _buckets(slab)
        for gap in range(1, WINDOW + 1):
            near = slab.doc[gap:] == slab.doc[:-gap]
            left, right = w[:-gap][near], w[gap:][near]
            for a, b in ((left, right), (right, left)):
                for j in range(NONZERO):
                    total += np.bincount(a * DIM + places[b, j], signs[b, j], minlength=BUCKETS * DIM)
    salt = TaskContext.get().partitionId() % SALTS
    rows = total.reshape(-1, BLOCK * DIM)
    used = [i for i in range(len(rows)) if rows[i].any()]
    yield pa.RecordBatch.from_pydict({"block": pa.array(used, pa.int32()), "salt": pa.array([salt] * len(used), pa.int32()),
                                      "sums": pa.array([rows[i].astype("<f4").tobytes() for i in used], pa.binary())})


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK * DIM)
    for blob in table.column("sums"):
        total += np.frombuffer(blob.as_py(), "<f4")
    return pa.table({"block": table.column("block")[:1], "salt": table.column("salt")[:1],
                     "sums": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The corpus's context vectors, unit length; BUCKETS x DIM whatever the corpus."""
    schema = "block int, salt int, sums binary"
    sums = arrow_map(docs.select(column(docs, "text").alias("text")), _context_sums, schema)
    sums = sums.groupBy("block", "salt").applyInArrow(_added, schema).groupBy("block").applyInArrow(_added, schema)
    out = np.zeros((BUCKETS // BLOCK, BLOCK * DIM), np.float32)
    for row in sums.collect():  # BUCKETS / BLOCK rows
        out[row.block] = np.frombuffer(row.sums, "<f4")
    out = out.reshape(BUCKETS, DIM)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """One row of FEATURES numbers a text."""
    n = len(texts)
    slab = Slab(texts)
    out = np.zeros((n, FEATURES))
    if not len(slab.start):
        return out
    w, count = _buckets(slab), np.bincount(slab.doc, minlength=n)
    safe = np.maximum(count, 1)
    alike, same = np.zeros(n), np.zeros(n)
    for at in range(0, len(w), PIECE):  # with the first word of the next piece, for the pair across
        own, doc = vectors[w[at:at + PIECE + 1]], slab.doc[at:at + PIECE + 1]
        near = np.flatnonzero(doc[1:] == doc[:-1])
        alike += np.bincount(doc[near], np.einsum("ij,ij->i", own[near], own[near + 1]), n)
        same += np.bincount(doc[near], w[at + near] == w[at + near + 1], n)
        own, doc = own[:PIECE], doc[:PIECE]
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        out[doc[first], :DIM] += np.add.reduceat(own, first, axis=0)
    out[:, :DIM] /= safe[:, None]
    sums = [alike, same, *[np.bincount(slab.doc, slab.kind == k, n) for k in (1, 2, 3)], np.bincount(slab.doc, slab.end - slab.start, n) / 8]
    for i, s in enumerate(sums):
        out[:, DIM + i] = s / safe
    out[:, DIM + 6] = np.log1p(count)
    return out


def features(docs: DataFrame, vectors: np.ndarray, keep: Column) -> DataFrame:
    """(keep, x) for each row; x as packed 4-byte floats, so the table stays small."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vectors)
    rows = docs.select(keep.alias("keep"), column(docs, "text").alias("text"))
    kind = rows.schema["keep"].dataType.simpleString()

    def pool(batches):
        for part, texts in slabs(batches):
            x = pooled(texts, sent.value).astype("<f4")
            yield pa.RecordBatch.from_arrays([part.column("keep"), pa.array([r.tobytes() for r in x], pa.binary())], ["keep", "x"])

    return arrow_map(rows, pool, f"keep {kind}, x binary")


def trained(feats: DataFrame, labels: DataFrame, label: str, folds: int, held: int,
            max_labelled: int = MAX_LABELLED) -> network.Network:
    """From the labelled rows outside the held-out fold, ``max_labelled`` of them at most."""
    marks = labels.select(column(labels, "doc_id").alias("id"), column(labels, label).alias("y"))
    marks = marks.where(F.col("y").isNotNull() & F.col("id").isNotNull() & (fold(F.col("id"), folds) != held))
    seen = feats.join(marks, F.col("keep") == F.col("id")).select("id", "x", "y")
    rows = seen.orderBy(F.xxhash64("id"), "id", "y", "x").limit(max_labelled).collect()
    x = np.array([np.frombuffer(r.x, "<f4") for r in rows], float).reshape(-1, FEATURES)
    return network.fit(x, np.array([r.y for r in rows], int))


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _score(feats: DataFrame, net: network.Network) -> DataFrame:
    kind = feats.schema["keep"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), "<f4").astype(float).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("keep"), pa.array(net.probabilities(x))], ["keep", "score"])

    return arrow_map(feats, score, f"keep {kind}, score double")


def scores(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0,
           threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    feats = materialize(features(docs, word_vectors(docs), column(docs, "doc_id")), "quality-features")
    net = trained(feats, labels, label, folds, held, max_labelled)
    out = _score(feats, net).withColumnRenamed("keep", "doc_id")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The documents that score at least ``threshold``, whole rows: those that ``scores`` predicts 1.
    The text is pooled again beside its row, so no join moves it."""
    vectors = word_vectors(docs)
    texts = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text").alias("text"))
    ids = sampled_ids(labels, "quality", 5, 0, max_labelled, texts.select("doc_id"))
    marked = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("__quality_id"), "left_semi")
    net = trained(features(marked, vectors, F.col("doc_id")), labels, "quality", 5, 0, max_labelled)
    spark, kept = docs.sparkSession, docs.select(whole_rows(docs).alias("row"), column(docs, "text").alias("text"))
    sent = spark.sparkContext.broadcast((vectors, net))

    def keep(batches):
        for part, texts in slabs(batches):
            vectors, net = sent.value
            good = net.probabilities(pooled(texts, vectors).astype("<f4").astype(float)) >= threshold
            yield part.select(["row"]).filter(pa.array(good))

    return unwrapped(arrow_map(kept, keep, kept.select("row").schema), "row", docs)


def sampled_ids(labels: DataFrame, label: str, folds: int, held: int, most: int, of: DataFrame | None = None) -> DataFrame:
    """``most`` doc_ids at most: those labelled, outside the held-out fold, of smallest hash.
    ``of``: a table of the doc_ids to choose from."""
    ids = labels.where(column(labels, label).isNotNull() & column(labels, "doc_id").isNotNull()
                       & (fold(column(labels, "doc_id"), folds) != held))
    ids = ids.select(column(labels, "doc_id").alias("__quality_id")).distinct()
    if of is not None:
        ids = ids.join(of.select(F.col("doc_id").alias("__of")), F.col("__quality_id") == F.col("__of"), "left_semi")
    return ids.orderBy(F.xxhash64("__quality_id"), "__quality_id").limit(most)
