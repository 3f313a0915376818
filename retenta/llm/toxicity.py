"""Toxicity classifier with counterfactual regularisation.

Features are hashed: each word (letters, lower case) and its first 4, 5 and 6 bytes fall
into ``BUCKETS`` buckets; a document has a feature or not.

1. At most ``MAX_LABELLED`` labelled documents outside the held-out fold (smallest hash of
   doc_id; the bound is a parameter) are taken with their whole texts; their ids are few
   enough to broadcast, so no text is shuffled. Spark counts each bucket's documents by
   label and the ``CHOSEN`` buckets that part the labels best become the model's features.
2. Every sentence of these documents that names a group is swapped: each identity term for
   the next one of its list. A logistic model is fitted by Adam to the labels, plus
   ``PENALTY`` times the mean square of the score change (in logits) between a sentence and
   its swap, over all sentences whose chosen features a swap changes. That mean needs only the
   sum of d d^T over the feature differences d, which Spark adds up: a matrix of ``CHOSEN``
   squared numbers, however many sentences there are. Terms that name a group thus can't carry weight that other terms of the list
   don't carry, however often labelled insults stand beside them.
3. Every document is scored in one pass without a shuffle.

Edge cases: null texts are empty; a text without words has the model's base score; null
labels and labels without a document are left out; with labels of one class, or none, the
score is constant. Rows repeated in the input are scored alike. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retenta.llm.frames import arrow_map, column, slabs
from retenta.llm.network import sigmoid
from retenta.llm.quality import fold, sampled_ids
from retenta.llm.words import Slab

BUCKETS = 1 << 18
CHOSEN = 1024
MAX_LABELLED = 20_000
THRESHOLD = 0.7
PENALTY = 1.0
PREFIXES = (4, 5, 6)
#: A feature needs that many labelled documents and that much evidence (log odds times the root of its count).
LEAST_DOCUMENTS = 3
LEAST_WEIGHT = 5.0

#: Terms that name groups, in lists within which a swap keeps the sentence's sense.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("she", "he"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives"), ("old", "young"), ("disabled", "blind", "deaf"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("einwanderer", "flüchtlinge"),
)
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")
_NEXT = {t: terms[(i + 1) % len(terms)] for terms in IDENTITY_TERMS for i, t in enumerate(terms)}
_TERM = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, _NEXT), key=len, reverse=True)) + r")(?!\w)", re.I)


def swapped(sentence: str) -> str:
    return _TERM.sub(lambda m: _NEXT[m[0].lower()], sentence)


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs."""
    slab = Slab(texts, lower=True)
    letters = slab.kind == 1
    start, end, doc = slab.start[letters], slab.end[letters], slab.doc[letters]
    docs, buckets = [doc], [slab.hashes(start, end)]
    for n in PREFIXES:
        long = end - start > n
        docs.append(doc[long])
        buckets.append(slab.hashes(start[long], start[long] + n) ^ np.uint64(0xA5A5 * n))
    key = np.unique(np.concatenate(docs) * BUCKETS + (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64))
    return key // BUCKETS, key % BUCKETS


def _chosen_rows(texts: list[bytes], place: np.ndarray) -> np.ndarray:
    """One 0/1 row of the chosen features a text, packed to bits."""
    doc, bucket = _features(texts)
    at = place[bucket]
    x = np.zeros((len(texts), CHOSEN), np.uint8)
    x[doc[at >= 0], at[at >= 0]] = 1
    return np.packbits(x, axis=1)


def _unpacked(rows: np.ndarray) -> np.ndarray:
    return np.unpackbits(rows, axis=1).view(np.int8)


def _found(y: list[int] | None, x: list[bytes] | None, i: list[int] | None, j: list[int] | None, n: list[int]) -> pa.RecordBatch:
    values = [(y, pa.int32()), (x, pa.binary()), (i, pa.int32()), (j, pa.int32()), (n, pa.int64())]
    return pa.RecordBatch.from_arrays([pa.nulls(len(n), k) if v is None else pa.array(v, k) for v, k in values],
                                      ["y", "x", "i", "j", "n"])


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    for part, texts in slabs(batches):
        y = (part.column("y").to_numpy(zero_copy_only=False) > 0).astype(np.int64)
        doc, bucket = _features(texts)
        for label in (0, 1):
            total[label] += np.bincount(bucket[y[doc] == label], minlength=BUCKETS)
    used = np.flatnonzero(total.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[1][used]), pa.array(total[0][used])],
                                     ["bucket", "toxic", "clean"])


def _pairs(batch_texts: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    plain, other = [], []
    for text in batch_texts:
        s = text.decode("utf-8", "replace")
        if _TERM.search(s):
            for sentence in _SENTENCE.split(s):
                if _TERM.search(sentence):
                    plain.append(sentence.encode())
                    other.append(swapped(sentence).encode())
    return plain, other


class Model:
    def __init__(self, place: np.ndarray, weights: np.ndarray, base: float):
        self.place, self.weights, self.base = place, weights, base

    def scores(self, texts: list[bytes]) -> np.ndarray:
        doc, bucket = _features(texts)
        at = self.place[bucket]
        return sigmoid(self.base + np.bincount(doc[at >= 0], self.weights[at[at >= 0]], len(texts)))


def _fit(x: np.ndarray, y: np.ndarray, many: np.ndarray, apart: np.ndarray, steps: int = 400, rate: float = 0.05,
         decay: float = 1e-5, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """``many``: how many documents a row stands for; ``apart``: the mean of d d^T over the
    feature differences d between sentences and their swaps."""
    p = np.zeros(x.shape[1] + 1, np.float32)
    share = many / many.sum()
    mean = share @ y
    p[-1] = np.log((mean + 1e-3) / (1 - mean + 1e-3))
    first, second = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        err = ((sigmoid(x @ p[:-1] + p[-1]) - y) * share).astype(np.float32)
        grad = np.append(x.T @ err + decay * p[:-1], err.sum())
        grad[:-1] += 2 * penalty * (apart @ p[:-1])
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        p -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return p[:-1].astype(float), float(p[-1])


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held: int = 1,
            max_labelled: int = MAX_LABELLED, penalty: float = PENALTY) -> Model:
    ids = sampled_ids(labels, label, folds, held, max_labelled)
    marks = (labels.select(column(labels, "doc_id").alias("id"), column(labels, label).alias("y"))
             .join(F.broadcast(ids), F.col("id") == F.col("__quality_id"), "left_semi").where("y is not null"))
    marks = marks.groupBy("id").agg(F.avg("y").alias("y")).select("id", (F.col("y") >= 0.5).cast("int").alias("y"))
    marked = docs.select(column(docs, "doc_id").alias("of"), column(docs, "text").alias("text")).join(
        F.broadcast(marks), F.col("of") == F.col("id")).select("id", "y", "text")
    counts = arrow_map(marked.select("y", "text"), _label_counts, "bucket long, toxic long, clean long")
    counts = counts.groupBy("bucket").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    n1, n0 = marks.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    place, weights = np.full(BUCKETS, -1, np.int64), np.zeros(CHOSEN)
    if not n1 or not n0:
        return Model(place, weights, 20.0 if n1 else -20.0)
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    weight = F.abs(odds) * F.sqrt(F.greatest("a", F.col("b") * n1 / n0))
    best = counts.where((F.col("a") + F.col("b") >= LEAST_DOCUMENTS) & (weight >= LEAST_WEIGHT))
    best = best.orderBy(weight.desc(), "bucket").limit(CHOSEN)
    for i, row in enumerate(best.collect()):  # CHOSEN rows at most
        place[row.bucket] = i
    sent = docs.sparkSession.sparkContext.broadcast(place)

    def rows(batches):
        total, swaps = np.zeros((CHOSEN, CHOSEN), np.int64), 0
        for part, texts in slabs(batches):
            x = [r.tobytes() for r in _chosen_rows(texts, sent.value)]
            yield _found(part.column("y").to_pylist(), x, None, None, [1] * len(x))
            plain, other = _pairs(texts)
            if plain:
                d = _unpacked(_chosen_rows(plain, sent.value)) - _unpacked(_chosen_rows(other, sent.value))
                d = d[d.any(axis=1)]
                used = np.flatnonzero(d.any(axis=0))
                d = d[:, used].astype(float)
                total[np.ix_(used, used)] += (d.T @ d).astype(np.int64)
                swaps += len(d)
        i, j = np.nonzero(np.triu(total))
        yield _found(None, None, [*i.tolist(), -1], [*j.tolist(), -1], [*total[i, j].tolist(), swaps])

    found = arrow_map(marked.select("y", "text"), rows, "y int, x binary, i int, j int, n long")
    # labelled rows (their ids are at most max_labelled) and half of CHOSEN * CHOSEN sums; nothing is cut
    found = found.groupBy("y", "x", "i", "j").agg(F.sum("n").alias("n")).orderBy("y", "x", "i", "j").collect()
    own = [r for r in found if r.y is not None]
    if not own:  # no labelled id is among the documents
        return Model(place, weights, float(np.log(n1 / n0)))
    x = _unpacked(np.frombuffer(b"".join(r.x for r in own), np.uint8).reshape(-1, CHOSEN // 8)).astype(np.float32)
    y, many = np.array([r.y for r in own], float), np.array([r.n for r in own], float)
    apart, swaps = np.zeros((CHOSEN, CHOSEN)), sum(r.n for r in found if r.i == -1)
    for r in found:
        if r.i is not None and r.i >= 0:
            apart[r.i, r.j] = apart[r.j, r.i] = r.n / swaps
    w, base = _fit(x, y, many, apart.astype(np.float32), penalty=penalty)
    return Model(place, w, base)


def scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, threshold: float = THRESHOLD,
           max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, "toxic", folds, held, max_labelled))
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text").alias("text"))

    def score(batches):
        for part, texts in slabs(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sent.value.scores(texts))], ["doc_id", "score"])

    out = arrow_map(rows, score, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
