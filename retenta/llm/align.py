"""Alignment of two tokenizers' tokens by interval coalescing.

A text, a blank before it, is encoded by two vocabularies, and every token becomes an interval of
bytes. All intervals of both are sorted by their start together; the running maximum of their
ends shows where a group ends: a start that reaches it. Within a group every token of one side is
linked with every token of the other. Where both sides tile the same bytes, groups are cut
exactly at the offsets where a token of each ends.

1. Chunks. Neither vocabulary joins a sign that isn't white space with a blank after it, so a text
   falls into chunks there that are encoded, and aligned, as if alone. Whether this
   holds is read off the vocabularies' pieces; otherwise a text is one chunk.
2. Of a slab of documents (``SLAB`` bytes of text) each distinct chunk is encoded once, many are
   aligned in one sort, and the slab becomes one row: per document its tokens, groups
   and links counted, the digest of its groups, and the places of its chunks among the slab's
   distinct ones; each chunk's id pairs; each id pair and how many documents of the slab hold it.
3. Spark sums the documents of every id pair over the slabs, and finds each A id's highest sum
   (one row an A id: bounded by the vocabulary).
4. The sums go back to the slabs that asked, which add them up over their documents' links.

What travels is each slab's distinct pairs, and its rows packed; a slab asks for a frequent pair
once, so no key grows with the corpus but by one row a slab.

Edge cases: null and empty texts, and texts whose tokens' bytes on either side are not the text's
with a blank before it (U+2581 in the text, for one), have no tokens: counts are 0 and the digest
is ''. Null doc_ids and repeated rows stay rows of their own and count as documents of their own.
An empty table gives an empty result; other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from retenta.llm.bpe import BLANK, Pieces
from retenta.llm.frames import arrow_map, column, slabs
from retenta.session import materialize

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
SLAB = 16 << 20
_CUT = re.compile(f"(?<=[^{BLANK}])(?= )")
_loaded: dict[tuple, object] = {}


class Sides:
    """The two vocabularies: ids and, for each id, its bytes."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.a_bytes = Pieces.of(a)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.blank = self.b.piece_to_id("▁")
        self.cuts = self.b.id_to_piece(self.blank) == "▁" and not any(
            _CUT.search(p.decode("utf-8", "replace")) for p in self.a_bytes + self.b_bytes)
        #: per side, each id's name before another of its side, and as the last of its side
        self.names = [tuple(np.array([f"{i}{end}" for i in range(len(t))], object) for end in (",", last))
                      for t, last in ((self.a_bytes, "|"), (self.b_bytes, ";"))]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))

    @classmethod
    def of(cls, a: str, b: str) -> Sides:
        if (a, b) not in _loaded:
            _loaded[a, b] = cls(a, b)
        return _loaded[a, b]

    def encode(self, chunks: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Of both sides the ids of all chunks whose tokens' bytes are the chunk's, and how many of
        each; and which chunks these are."""
        joined = "".join(chunks)
        other = self.b.encode([c[1:] for c in chunks], num_threads=1)  # it puts the blank back, but not before nothing
        other = [y if len(c) > 1 else [self.blank] for c, y in zip(chunks, other, strict=True)]
        both = [_flat([e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]), _flat(other)]
        lengths = np.fromiter(map(len, chunks if joined.isascii() else map(str.encode, chunks)), np.int64, len(chunks))
        fine = np.ones(len(chunks), bool)
        for (ids, count), table, size in zip(both, (self.a_bytes, self.b_bytes), (self.a_size, self.b_size), strict=True):
            ends = np.append(0, np.cumsum(size[ids]))[np.cumsum(count)]
            if b"".join(map(table.__getitem__, ids.tolist())) != joined.encode() or (np.diff(ends, prepend=0) != lengths).any():
                parts = np.split(ids, np.cumsum(count)[:-1])
                fine &= [b"".join(map(table.__getitem__, x.tolist())) == c.encode() for x, c in zip(parts, chunks, strict=True)]
        return [ids[np.repeat(fine, count)] for ids, count in both], [count[fine] for _, count in both], fine


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, count.sum()), count


def chunks_of(text: str, cuts: bool = True) -> list[str]:
    """A text that begins with a blank, cut before each blank that follows no white space."""
    return _CUT.split(text) if cuts else [text]


def groups_of(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of all intervals by start (then end, then side), and each one's group in it."""
    order = np.lexsort((side, end, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.append(True, start[order][1:] >= reach[:-1])
    return order, np.cumsum(fresh) - 1


def _unique_counts(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id), sorted, and how often each occurs."""
    key, n = np.unique(group << 32 | ids, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, n


def linked(group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links of all groups: (group, a id, b id, how many occurrence pairs)."""
    ga, ia, na = _unique_counts(group_a, a)
    gb, ib, nb = _unique_counts(group_b, b)
    first, last = np.searchsorted(gb, ga), np.searchsorted(gb, ga, "right")
    many = last - first
    at = np.repeat(np.arange(len(ga)), many)
    other = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    return ga[at], ia[at], ib[other], na[at] * nb[other]


class Aligned:
    """Chunks aligned: per chunk whether it has tokens (``fine``), the ``counts`` of A tokens, B
    tokens, groups and links, and its groups as text, each closed by a semicolon; and all links, by
    chunk: the chunk's place, the pair of ids, and how often it occurs."""

    def __init__(self, fine, counts, texts, links):
        self.fine, self.counts, self.texts, self.links = fine, counts, texts, links


def _group_texts(sides: Sides, ids: list[np.ndarray], groups: list[np.ndarray], edge: np.ndarray) -> list[str]:
    """The groups between two edges as one text: a1,a2|b1;"""
    key = np.concatenate((2 * groups[0], 2 * groups[1] + 1))
    order = np.argsort(key, kind="stable")
    key = key[order]
    last = np.append(key[1:] != key[:-1], True)  # of its side of the group
    words = np.concatenate([comma[i] for (comma, _), i in zip(sides.names, ids, strict=True)])[order]
    ends = np.concatenate([end[i] for (_, end), i in zip(sides.names, ids, strict=True)])[order]
    words = np.where(last, ends, words).tolist()
    at = np.searchsorted(key, 2 * edge).tolist()
    return ["".join(words[x:y]) for x, y in itertools.pairwise(at)]


def _aligned(sides: Sides, chunks: list[str]) -> Aligned:
    ids, count, fine = sides.encode(chunks)
    counts, texts = np.zeros((len(chunks), 4), np.int64), [""] * len(chunks)
    if not fine.any():
        return Aligned(fine, counts, texts, np.empty((3, 0), np.int64))
    size = [table[i] for table, i in zip((sides.a_size, sides.b_size), ids, strict=True)]
    end = [np.cumsum(s) for s in size]
    start = [e - s for e, s in zip(end, size, strict=True)]
    side = np.repeat((0, 1), (len(ids[0]), len(ids[1])))
    order, group = groups_of(np.concatenate(start), np.concatenate(end), side)
    of = np.empty(len(order), np.int64)
    of[order] = group
    groups = [of[:len(ids[0])], of[len(ids[0]):]]
    # both sides tile all chunks, so each chunk begins a group, and its groups are neighbours
    edge = np.append(groups[0][np.cumsum(count[0]) - count[0]], group[-1] + 1)
    links = np.add.reduceat(np.bincount(groups[0]) * np.bincount(groups[1]), edge[:-1])
    counts[fine] = np.stack((*count, np.diff(edge), links), axis=1)
    places = np.flatnonzero(fine)
    for i, text in zip(places.tolist(), _group_texts(sides, ids, groups, edge), strict=True):
        texts[i] = text
    g, la, lb, mult = linked(groups[0], ids[0], groups[1], ids[1])
    chunk = places[np.searchsorted(edge, g, "right") - 1]
    return Aligned(fine, counts, texts, np.stack((chunk, la << 32 | lb, mult)))


def align(sides: Sides, chunks: list[str], step: int = 1 << 15) -> Aligned:
    """``step`` chunks in one sort."""
    parts = [_aligned(sides, chunks[i:i + step]) for i in range(0, len(chunks), step)]
    for i, p in enumerate(parts):
        p.links[0] += i * step
    none = Aligned(np.empty(0, bool), np.empty((0, 4), np.int64), [], np.empty((3, 0), np.int64))
    return Aligned(np.concatenate([p.fine for p in (none, *parts)]), np.concatenate([p.counts for p in (none, *parts)]),
                   list(chain.from_iterable(p.texts for p in parts)), np.concatenate([p.links for p in (none, *parts)], axis=1))


class _Places(dict):
    """Numbers chunks in the order in which they are first asked for."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        return n


def _cut_and_aligned(sides: Sides, texts: list[bytes]) -> tuple[list[np.ndarray], Aligned]:
    """Each text's chunks by their places among the distinct ones, none for a text without
    tokens; and the distinct ones aligned."""
    place = _Places()
    places = []
    for t in texts:
        chunks = chunks_of(" " + t.decode("utf-8", "replace"), sides.cuts) if t else []
        places.append(np.fromiter(map(place.__getitem__, chunks), np.uint32, len(chunks)))
    found = align(sides, list(place))
    if not found.fine.all():
        places = [p if found.fine[p].all() else p[:0] for p in places]
    return places, found


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpacked(x: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype)


DOCS = "ids array<long>, counts binary, digests array<string>"
SLABS = f"slab long, {DOCS}, places binary, chunks int, links binary, pairs array<long>, held array<int>"


def _slab_row(slab: int, doc_ids: list, texts: list[bytes], sides: Sides) -> pa.RecordBatch:
    places, found = _cut_and_aligned(sides, texts)
    counts = np.array([found.counts[p].sum(axis=0) for p in places], np.int64).reshape(-1, 4)
    digests = [hashlib.sha256("".join(map(found.texts.__getitem__, p.tolist()))[:-1].encode()).hexdigest() if len(p) else "" for p in places]
    flat = np.concatenate([*places, np.empty(0, np.uint32)])
    n = len(found.fine)
    used = np.bincount(flat, minlength=n) > 0  # by texts with tokens
    chunk, pair, mult = found.links[:, used[found.links[0]]]
    many = np.bincount(chunk, minlength=n)
    pairs, which = np.unique(pair, return_inverse=True)
    # documents that hold a pair: each document's distinct chunks, their pairs, distinct
    held, edge = np.zeros(len(pairs), np.int32), np.append(0, np.cumsum(many))
    for p in places:
        mine = np.unique(p)
        own = many[mine]
        at = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + np.repeat(edge[mine], own)
        held[np.unique(which[at])] += 1
    lengths = np.array([len(p) for p in places], np.int64)
    row = {"slab": [slab], "ids": [doc_ids], "counts": [np.concatenate((counts, lengths[:, None]), axis=1).tobytes()], "digests": [digests],
           "places": [_packed(flat)], "chunks": [n], "links": [_packed(np.concatenate((many, which, mult)).astype("<i4"))], "pairs": [pairs],
           "held": [held]}
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row))


def _slabs(a: str, b: str):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides.of(a, b)
        slab = TaskContext.get().partitionId() << 32
        for part, texts in slabs(_joined(batches), limit=SLAB):
            yield _slab_row(slab, part.column("doc_id").to_pylist(), texts, sides)
            slab += 1
    return make


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about SLAB bytes: Arrow's own follow the number of rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SLAB:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def slab_table(docs: DataFrame, a: str, b: str) -> DataFrame:
    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text"))
    return materialize(arrow_map(rows, _slabs(a, b), SLABS), "align-slabs")


def _asked(table: DataFrame) -> DataFrame:
    return table.select("slab", F.explode(F.arrays_zip("pairs", "held")).alias("x")).select(
        "slab", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, documents, best): each id pair's documents; best: whether no pair of its A id has more."""
    counts = materialize(_asked(table).groupBy("pair").agg(F.sum("held").alias("documents")), "align-counts")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("documents").alias("most"))  # a row an A id: bounded by its vocabulary
    return counts.join(F.broadcast(most), a == F.col("a")).select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def links(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """The corpus's table of linked ids: a_id, b_id, documents, best."""
    table = slab_table(docs, a or public_tokenizers.path(A_FILE), b or public_tokenizers.path(B_FILE))
    return pair_counts(table).select(F.shiftright("pair", 32).cast("int").alias("a_id"),
                                     F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"), "documents", "best")


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _summed(rows: pa.Table, answers: pa.Table) -> pa.Table:
    out: list[list] = [[] for _ in range(8)]
    for row in rows.to_pylist():
        order = np.argsort(answers.column("pair").to_numpy())  # a slab's pairs are sorted too
        documents, best = (answers.column(c).to_numpy()[order].astype(np.int64) for c in ("documents", "best"))
        table = np.frombuffer(row["counts"], np.int64).reshape(-1, 5)
        flat = _unpacked(row["links"], "<i4").astype(np.int64)
        n = row["chunks"]
        many, which, mult = flat[:n], flat[n:n + (len(flat) - n) // 2], flat[n + (len(flat) - n) // 2:]
        edge = np.append(0, np.cumsum(many))
        sums = [np.append(0, np.cumsum(mult * x[which])) for x in (best, documents)]
        by_chunk = [s[edge[1:]] - s[edge[:-1]] for s in sums]
        places = _unpacked(row["places"], "<u4")
        ends = np.append(0, np.cumsum(table[:, 4]))
        run = [np.append(0, np.cumsum(x[places])) for x in by_chunk]
        out[0] += row["ids"]
        for i in range(4):
            out[i + 1] += table[:, i].tolist()
        for i, r in enumerate(run):
            out[5 + i] += (r[ends[1:]] - r[ends[:-1]]).tolist()
        out[7] += row["digests"]
    names = [f.split()[0] for f in RESULT.split(", ")]
    return pa.table([pa.array(x, pa.string() if c == "groups_sha256" else pa.int64()) for x, c in zip(out, names, strict=True)], names=names)


def alignment_digest(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    table = slab_table(docs, a or public_tokenizers.path(A_FILE), b or public_tokenizers.path(B_FILE))
    counts = pair_counts(table)
    answers = _asked(table).join(counts, "pair").select(F.col("slab").alias("of"), "pair", "documents", "best")
    return table.drop("pairs", "held").groupBy("slab").cogroup(answers.groupBy("of")).applyInArrow(_summed, RESULT)


def token_groups(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """The groups themselves: doc_id, group, a_ids, b_ids; one row a group."""
    a, b = a or public_tokenizers.path(A_FILE), b or public_tokenizers.path(B_FILE)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides.of(a, b)
        for part, texts in slabs(batches):
            places, found = _cut_and_aligned(sides, texts)
            for doc_id, p in zip(part.column("doc_id").to_pylist(), places, strict=True):
                if len(p):
                    groups = [g.split("|") for g in "".join(map(found.texts.__getitem__, p.tolist()))[:-1].split(";")]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id] * len(groups), pa.int64()), pa.array(range(len(groups)), pa.int64()),
                        *[pa.array([[int(i) for i in g[s].split(",")] for g in groups], pa.list_(pa.int32())) for s in (0, 1)]],
                        ["doc_id", "group", "a_ids", "b_ids"])

    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text"))
    return arrow_map(rows, make, "doc_id long, group long, a_ids array<int>, b_ids array<int>")
