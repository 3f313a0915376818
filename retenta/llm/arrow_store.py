"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned by doc_id and sorted; each task encodes its documents, joins
their ids (each document closed by ``end_id``) and writes them as one Arrow file: batches of
``BATCH`` rows with two fixed-size-list columns, ``ids`` and ``mask`` (false on the padding of
the last sequence). Fixed sizes make the position of any token a division, and a mapped file
gives batches without copying. ids take 2 bytes if the vocabulary allows it.

Files are written under the shared folder, to a name of the attempt's own, and then moved to
the part's name: a repeated or lost attempt leaves either the whole file or none, and every
attempt's bytes are the same because the rows are sorted by all they hold. The index
(doc_id, part, place, start in the part, n_tokens) is a written table beside them; totals
of the parts, one row each, give the global starts.

Encoding: the tokenizer drops white space and no token spans it, so words between blanks and
line ends are encoded apart and remembered by the worker (``tokenizer.WordIds``).

Edge cases: null texts are empty and hold the end id alone; null doc_ids come first; rows of
one doc_id are ordered by the hash of their text, then by the text; an empty table gives
no file and an empty result; a text longer than a sequence runs over as many as it needs.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from retenta.llm import tokenizer
from retenta.llm.frames import SLAB, arrow_map, column, partitions
from retenta.session import materialize, scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SEQUENCE = 2048
BATCH = 256


def schema_of(dtype: str, sequence: int = SEQUENCE) -> pa.Schema:
    kind = pa.uint16() if dtype == "<u2" else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class _Part:
    """One file of sequences, filled from whole documents."""

    def __init__(self, uri: str, name: str, dtype: str, sequence: int, batch: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.folder, recursive=True)
        self.path = f"{self.folder}/{name}.arrow"
        self.own = f"{self.folder}/_{name}-{uuid.uuid4().hex}"
        self.schema, self.dtype, self.sequence, self.batch = schema_of(dtype, sequence), np.dtype(dtype), sequence, batch
        self.out = self.fs.open_output_stream(self.own)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.held, self.n = [], 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n += len(ids) // self.dtype.itemsize
        if self.n >= self.batch * self.sequence:
            self._write(self.n // (self.batch * self.sequence) * self.batch * self.sequence)

    def _write(self, n: int) -> None:
        """The first n ids held, in batches; fewer than a sequence's length are padded."""
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        self.held, rest = [ids[n:].tobytes()], ids[:n]
        self.n -= n
        short = -n % self.sequence
        mask = np.ones(n + short, bool)
        mask[n:] = False
        rest = np.concatenate((rest, np.zeros(short, self.dtype)))
        step = self.batch * self.sequence
        for at in range(0, len(rest), step):
            self.writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(x[at:at + step]), self.sequence) for x in (rest, mask)], schema=self.schema))

    def close(self) -> None:
        if self.n:
            self._write(self.n)
        self.writer.close()
        self.out.close()
        self.fs.move(self.own, self.path)


class Reader:
    """Random access to one part: the ids from any position on, without copying when they lie
    in one batch and the file is local."""

    def __init__(self, uri: str, name: str):
        fs, folder = pafs.FileSystem.from_uri(uri)
        path = f"{folder}/{name}.arrow"
        local = isinstance(fs, pafs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(path) if local else fs.open_input_file(path))
        self.sequence = self.file.schema.field("ids").type.list_size
        self.per_batch = self.file.get_batch(0).num_rows * self.sequence if self.file.num_record_batches else 1
        self.last = (-1, None, None)

    def _batch(self, i: int):
        if self.last[0] != i:
            batch = self.file.get_batch(i)
            self.last = (i, batch.column("ids").values.to_numpy(), batch.column("mask").values)
        return self.last

    def ids(self, start: int, n: int) -> np.ndarray:
        parts = []
        while n:
            i, at = divmod(start, self.per_batch)
            _, ids, mask = self._batch(i)
            part = ids[at:at + n]
            if not len(part) or not mask[at].as_py() or not mask[at + len(part) - 1].as_py():
                raise ValueError(f"no tokens at {start}")
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _slabs(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices that hold about ``SLAB`` bytes of text (one text at least)."""
    of = pc.binary_length(texts).to_numpy().cumsum(dtype=np.int64) // SLAB
    edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
    for start, end in itertools.pairwise(edges):
        yield texts.slice(start, end - start)


def _name(part: int) -> str:
    return f"part-{part:06d}"


def write_tokens(docs: DataFrame, uri: str, path: str, end_id: int = END_ID, sequence: int = SEQUENCE,
                 batch: int = BATCH) -> DataFrame:
    """Writes the files under ``uri`` and returns the index: doc_id, part, place, start, n_tokens."""
    dtype = tokenizer.dtype_of(path, end_id)
    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), F.coalesce(column(docs, "text"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    close = np.array([end_id], dtype).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, place, start = TaskContext.get().partitionId(), None, 0, 0
        words = tokenizer.WordIds.of(path, dtype)
        for rows in batches:
            if not rows.num_rows:
                continue
            out = out or _Part(uri, _name(part), dtype, sequence, batch)
            counts = []
            for texts in _slabs(rows.column("text")):
                ids, n = words.of_texts(texts)
                ids, ends = ids.tobytes(), n.cumsum() * len(close)
                for a, b in zip((ends - n * len(close)).tolist(), ends.tolist(), strict=True):
                    out.add(ids[a:b] + close)
                counts += (n + 1).tolist()
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.full(len(counts), part, np.int32)), pa.array(np.arange(place, place + len(counts))),
                 pa.array(start + ends - counts), pa.array(np.array(counts, np.int64))], ["doc_id", "part", "place", "start", "n_tokens"])
            place, start = place + len(counts), start + int(ends[-1])
        if out:
            out.close()

    return materialize(arrow_map(rows, write, "doc_id long, part int, place long, start long, n_tokens long"), "token-index")


def read_tokens(spark, index: DataFrame, uri: str) -> DataFrame:
    """Per document, from the files: doc_id, start (over all parts), n_tokens, ids_crc32."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("part").alias("of"), F.coalesce(before, F.lit(0)).alias("before"))  # a row a part
    rows = index.join(offsets, F.col("part") == F.col("of")).select("doc_id", "part", "place", "start", "n_tokens", "before")
    rows = rows.repartition(partitions(spark), "part").sortWithinPartitions("part", "place")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, reader = None, None
        for batch in batches:
            crc, n = [], []
            for p, start, count in zip(*(batch.column(x).to_pylist() for x in ("part", "start", "n_tokens")), strict=True):
                if p != part:
                    part, reader = p, Reader(uri, _name(p))
                ids = reader.ids(start, count)
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
            start = pa.array(batch.column("start").to_numpy() + batch.column("before").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), start, pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow_map(rows, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(docs: DataFrame, path: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    uri = scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    index = write_tokens(docs, uri, path or public_tokenizers.path(VOCABULARY))
    return read_tokens(spark, index, uri)
