"""Removal of every byte that a repeated ``LENGTH``-byte string covers, by prefix doubling.

Prefix doubling ranks positions by their first h bytes, then by pairs of ranks h apart,
until a position is unique or h passes the threshold. Here:

* The rank of a position's prefix is a 64-bit name: 8 bytes as they are, then the mixed pair
  of names at growing offsets (8 + 8, 16 + 16, 32 + 32, 64 + 36 bytes). Names need no sort,
  so a task doubles them for its own documents; equal strings get equal names everywhere.
* Sorting finds the unique positions, and all positions would be 16 bytes of shuffle for
  each byte of text and round. So the first round sorts a sample that decides for the rest:
  every ``LENGTH``-byte window has an anchor, the position in it whose 32-byte name is least
  (leftmost of equals). Equal windows have equal anchors at equal places. Windows that share
  an anchor are neighbours, and are kept as one row, a span.
* Round 1 sorts spans by (anchor's name, name of the span, document, start). A span that
  equals an earlier one is wholly repeated. Spans whose anchor occurs in no other text are
  unique. What is left are spans that share an anchor but differ somewhere.
* Round 2 cuts only those into blocks of ``STEP`` windows, placed by the anchor, and sorts the
  blocks by the name of what all their windows have in common (``LENGTH - STEP + 1`` bytes)
  and by the name of the whole block, with the same three outcomes.
* Round 3 expands what is still left into single positions and sorts them by their names at
  100 bytes (two independent names, 128 bits); each but the earliest of a group is repeated.

The offsets thus grow from 32 over 93 to 100 bytes, and each round holds only the positions
that the one before could not decide.

Every task keeps only the first of equal names it meets itself and reports runs of the others
at once (a map-side combine that is exact, since the first is earlier), so a passage that
a third of all documents hold reaches the sort a few times per task. After the sort a task
reads its rows as a stream and holds one row of a group at a time.

Names decide equality within an anchor's group; two different spans of one group have equal
names with probability 2**-64.

Documents are ordered by doc_id (null first). Rows of one doc_id and equal text are judged
alike, as one; rows of one doc_id and different texts are ordered by the text's hash.

Edge cases: null texts are empty; texts under ``LENGTH`` bytes lose nothing; ties go to
the earlier start; an empty table gives an empty result; texts of any length are read in slabs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from retenta.llm.frames import arrow_map, column, partitions, row_variant, utf8
from retenta.session import materialize

LENGTH = 100
ANCHOR = 32
STEP = 8
#: Window starts handled at once, and spans or positions that a task combines at once.
SLICE = 1 << 19
COMBINE = 1 << 20
U = np.uint64
_PLACE = U((1 << 20) - 1)  # a position within a slice
SPANS = "anchor long, name long, doc_id long, variant long, start int, n int"
FOUND = "kind int, doc_id long, variant long, start int, n int"


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """The name of two adjacent (or overlapping) names."""
    with np.errstate(over="ignore"):
        x = a * U(0x9E3779B185EBCA87 + 2 * salt)
        x ^= x >> U(32)
        x += b * U(0xC2B2AE3D27D4EB4F + 2 * salt)
        x ^= x >> U(29)
        x *= U(0x165667B19E3779F9)
        x ^= x >> U(32)
        return x


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as a number (exact names of length 8)."""
    n = len(data) - 7
    out = np.empty(n, U)
    for s in range(8):
        part = data[s:s + (len(data) - s) // 8 * 8].view("<u8")
        out[s::8] = part[:len(out[s::8])]
    return out


def _doubled(data: np.ndarray, length: int, salt: int) -> np.ndarray:
    """Names of the ``length``-byte strings at all positions."""
    names, h = _eights(data), 8
    while h < length:
        step = min(h, length - h)
        names = _pair(names[:len(names) - step], names[step:], salt)
        h += step
    return names


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of length ANCHOR at all positions, and each window's anchor."""
    names = _doubled(data, ANCHOR, 0)
    low = (names & ~_PLACE) | np.arange(len(names), dtype=U)
    width, h = LENGTH - ANCHOR + 1, 1
    while h < width:
        step = min(h, width - h)
        low = np.minimum(low[:len(low) - step], low[step:])
        h += step
    return names, (low & _PLACE).astype(np.int64)


def _name_of(eights: np.ndarray, start: np.ndarray, size: np.ndarray, most: int, salt: int) -> np.ndarray:
    """Names of the byte runs at ``start``, ``size`` long (8 to ``most``)."""
    name, last = size.astype(U), start + size - 8
    for j in range(0, most, 8):
        name = _pair(name, eights[np.minimum(start + j, last)], salt)
    return name


def _runs(windows: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of adjacent windows begin whose ``same`` values are equal, and their lengths."""
    new = np.append(True, (np.diff(windows) != 1) | np.any([np.diff(x) != 0 for x in same], axis=0))
    first = np.flatnonzero(new)
    return first, np.diff(first, append=len(windows))


def _spans(data: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor's name and span's name of each span."""
    names, anchor = _anchors(data)
    anchor = anchor[windows]
    first, n = _runs(windows, anchor)
    start, anchor = windows[first], anchor[first]
    name = _name_of(_eights(data), start, n - 1 + LENGTH, 2 * LENGTH - ANCHOR, 5)
    return start, n, names[anchor], _pair(name, (anchor - start).astype(U), 6)


def _blocks(data: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, number of windows, name of what a whole block's windows have in common
    and name of the block, for blocks of STEP windows counted from the anchor."""
    anchor = _anchors(data)[1][windows]
    block = (windows - anchor) // STEP * STEP + anchor
    first, n = _runs(windows, anchor, block)
    start, block, eights = windows[first], block[first], _eights(data)
    common = _name_of(eights, block + STEP - 1, np.full(len(block), LENGTH - STEP + 1), LENGTH - STEP + 1, 11)
    name = _name_of(eights, start, n - 1 + LENGTH, LENGTH + STEP - 1, 12)
    return start, n, common, _pair(name, (start - block).astype(U), 13)


def _singles(data: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each window alone, with its two names."""
    return windows, np.ones(len(windows), np.int64), _doubled(data, LENGTH, 0)[windows], _doubled(data, LENGTH, 9)[windows]


def _slices(text: bytes, first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """The bytes of the windows from first to before last, SLICE windows at a time."""
    for at in range(first, last, SLICE):
        yield at, text[at:min(last, at + SLICE) + LENGTH - 1]


def _first_of_each(keys: tuple[np.ndarray, ...], order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers sorted by keys, then order, rows alike in both only once; and whether
    each is the first of its keys."""
    rows = np.lexsort((*order[::-1], *keys[::-1]))
    if not len(rows):
        return rows, np.ones(0, bool)
    new = np.append(True, np.any([k[rows][1:] != k[rows][:-1] for k in keys], axis=0))
    alone = new | np.append(True, np.any([k[rows][1:] != k[rows][:-1] for k in order], axis=0))
    return rows[alone], new[alone]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _merged(doc: np.ndarray, variant: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts, adjacent ones of a document joined."""
    rows = np.lexsort((start, variant, doc))
    doc, variant, start, n = doc[rows], variant[rows], start[rows], n[rows]
    new = np.append(True, (doc[1:] != doc[:-1]) | (variant[1:] != variant[:-1]) | (start[1:] != start[:-1] + n[:-1]))[:len(doc)]
    first = np.flatnonzero(new)
    return doc[first], variant[first], start[first], np.add.reduceat(n, first) if len(first) else n


def _combined(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Of (doc, variant, start, n, anchor, name) columns: the first row of each name, and runs
    of all others without names."""
    doc, variant, start, n, anchor, name = (np.concatenate(x) for x in zip(*held, strict=True))
    rows, new = _first_of_each((anchor, name), (doc, variant, start))
    again, rows = rows[~new], rows[new]
    known = _merged(doc[again], variant[again], start[again], n[again])
    places = [np.concatenate(x) for x in zip((doc[rows], variant[rows], start[rows], n[rows]), known, strict=True)]
    none = np.arange(len(places[0])) >= len(rows)
    names = [pa.array(np.append(_signed(x[rows]), np.zeros(len(known[0]), np.int64)), mask=none) for x in (anchor, name)]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    yield pa.RecordBatch.from_arrays([*names, *(pa.array(x, k) for x, k in zip(places, kinds, strict=True))],
                                     ["anchor", "name", "doc_id", "variant", "start", "n"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    for batch in batches:
        ids, variants = batch.column("doc_id").to_pylist(), batch.column("variant").to_pylist()
        for doc, variant, text in zip(ids, variants, utf8(batch.column("text")), strict=True):
            for at, data in _slices(text, 0, len(text) - LENGTH + 1):
                yield doc, variant, at, data


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _rows_of(_whole(batches), _spans)


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(x).to_numpy(zero_copy_only=False) for x in names]


def _found(kind: int, doc, variant, start, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(doc), kind, np.int32)), pa.array(doc.astype(np.int64)), pa.array(variant.astype(np.int64)),
         pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], ["kind", "doc_id", "variant", "start", "n"])


def _resolve_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by anchor, name, document, start: kind 1 is a repeated span, kind 2
    a span to expand."""
    before = pending = None  # the last row's names and its group's first place; the last first span if not reported
    for batch in batches:
        reported = batch.filter(batch.column("anchor").is_null())
        if reported.num_rows:
            yield _found(1, *_columns(reported, "doc_id", "variant", "start", "n"))
        batch = batch.filter(batch.column("anchor").is_valid())
        if not batch.num_rows:
            continue
        anchor, name, doc, variant, start, n = _columns(batch, "anchor", "name", "doc_id", "variant", "start", "n")
        new_anchor, new = np.ones(len(anchor), bool), np.ones(len(anchor), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new[1:] = new_anchor[1:] | (name[1:] != name[:-1])
        if before is not None:
            new_anchor[0] = before[0] != anchor[0]
            new[0] = new_anchor[0] or before[1] != name[0]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        led = np.array([np.where(lead < 0, before[2][i] if before else 0, x[lead]) for i, x in enumerate((doc, variant, start))])
        before = (anchor[-1], name[-1], led[:, -1])
        again = (led[0] != doc) | (led[1] != variant) | (led[2] != start)  # a row repeated in the input is no earlier one
        yield _found(1, doc[again], variant[again], start[again], n[again])
        first = np.flatnonzero(new)
        if not len(first):
            continue
        joins = ~new_anchor[first]  # an earlier span of the group is another text
        if joins[0] and pending is not None:
            yield _found(2, *pending)
        shared = joins.copy()
        shared[:-1] |= joins[1:]
        rows = first[shared]
        yield _found(2, doc[rows], variant[rows], start[rows], n[rows])
        tail = first[-1:]
        pending = None if shared[-1] else (doc[tail], variant[tail], start[tail], n[tail])


def _asked(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bytes]]:
    """doc_id, variant, first window and bytes of each run of asked windows; neighbouring
    spans are one run, up to SLICE windows."""
    lists = batch.column("spans")
    for i, text in enumerate(_unpacked(batch.column("packed"))):
        doc, variant, spans = batch.column("doc_id")[i].as_py(), batch.column("variant")[i].as_py(), lists[i].values
        start, n = (np.asarray(spans.field(x)).astype(np.int64) for x in ("start", "n"))
        order = np.argsort(start)
        start, n = start[order], n[order]
        run = np.cumsum(n) // (SLICE // 2)
        cut = np.flatnonzero(np.append(True, (start[1:] > start[:-1] + n[:-1]) | (run[1:] > run[:-1])))
        ends = np.append(start[cut[1:] - 1] + n[cut[1:] - 1], start[-1] + n[-1])
        for s, e in zip(start[cut].tolist(), ends.tolist(), strict=True):
            for at, data in _slices(text, s, e):
                yield doc, variant, at, data


def _lots(parts: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Parts whose bytes together are few, so that numpy's work isn't done part by part."""
    lot, size = [], 0
    for part in parts:
        lot.append(part)
        size += len(part[3])
        if size >= SLICE // 2:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def _rows_of(parts: Iterator[tuple], cut) -> Iterator[pa.RecordBatch]:
    """``cut`` takes the joined bytes of some parts (doc_id, variant, first window, bytes) and
    the windows that lie within a part, and gives first window, number of windows and two
    names of the pieces. A task's first of each name goes out with its names, the others as runs."""
    held: list[tuple] = []
    count = 0
    for lot in _lots(parts):
        doc, variant, at, sizes = (np.array(x, np.int64) for x in zip(*((d, v, a, len(t)) for d, v, a, t in lot), strict=True))
        ends = np.cumsum(sizes)
        of = np.repeat(np.arange(len(lot)), sizes)
        windows = np.flatnonzero(np.arange(len(of)) + LENGTH <= ends[of])
        start, n, anchor, name = cut(np.frombuffer(b"".join(t for *_, t in lot), np.uint8), windows)
        of = of[start]
        held.append((doc[of], variant[of], start - (ends - sizes)[of] + at[of], n, anchor, name))
        count += len(n)
        if count >= COMBINE:
            yield from _combined(held)
            held, count = [], 0
    if held:
        yield from _combined(held)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _rows_of((part for batch in batches for part in _asked(batch)), _blocks)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _rows_of((part for batch in batches for part in _asked(batch)), _singles)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the two joins that move them."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("variant"), pa.array(
            [press.compress(x) for x in utf8(batch.column("text"))], pa.binary())], ["doc_id", "variant", "packed"])


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    press = zstandard.ZstdDecompressor()
    return (press.decompress(x) for x in column.to_pylist())


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Dealt by anchor's name; what a task reported already goes anywhere."""
    n = partitions(rows.sparkSession)
    key = F.coalesce(F.col("anchor"), F.xxhash64("doc_id", "start"))
    return rows.repartition(n, key).sortWithinPartitions("anchor", "name", "doc_id", "variant", "start")


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents as doc_id, variant, packed text; the runs of repeated window starts as doc_id,
    variant, start, n)."""
    texts = docs.select(F.coalesce(column(docs, "doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
                        row_variant(docs).alias("variant"), column(docs, "text").alias("text"))
    first = arrow_map(texts, _span_rows, SPANS)
    texts = arrow_map(texts, _packed, "doc_id long, variant long, packed binary")
    found = materialize(arrow_map(_sorted_rows(first), _resolve_spans, FOUND), "repeat-spans")

    def asked(found: DataFrame) -> DataFrame:
        ask = found.where("kind = 2").select("doc_id", "variant", "start", "n").distinct()
        ask = ask.groupBy("doc_id", "variant").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
        return ask.join(texts, ["doc_id", "variant"])

    blocks = arrow_map(_sorted_rows(arrow_map(asked(found), _block_rows, SPANS)), _resolve_spans, FOUND)
    single = arrow_map(_sorted_rows(arrow_map(asked(blocks), _window_rows, SPANS)), _resolve_windows, FOUND)
    runs = found.unionByName(blocks).where("kind = 1").unionByName(single).select("doc_id", "variant", "start", "n")
    return texts, runs


def _resolve_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (x.filter(pc.equal(x.column("kind"), 1)) for x in _resolve_spans(batches))


def _covered(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs [from, to) that windows at start .. start + n - 1 cover."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(start, kind="stable")
    a = start[order].astype(np.int64)
    b = np.maximum.accumulate(a + n[order] - 1 + LENGTH)
    new = np.append(True, a[1:] > b[:-1])
    return a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]


def _kept(text: bytes, runs) -> tuple[bytes, int, int]:
    start, end = _covered(np.asarray(runs.field("start")), np.asarray(runs.field("n"))) if runs is not None else _covered(np.empty(0), np.empty(0))
    at, parts = 0, []
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]]), int((end - start).sum()), len(start)


def _cut(docs: DataFrame, last: str, kind: pa.DataType, value) -> DataFrame:
    texts, runs = repeated_windows(docs)
    per = runs.groupBy(F.col("doc_id").alias("of"), F.col("variant").alias("as")).agg(
        F.collect_list(F.struct("start", "n")).alias("runs"))
    both = texts.join(per, (F.col("doc_id") == F.col("of")) & (F.col("variant") == F.col("as")), "left")

    def cut(batches):
        for batch in batches:
            lists = batch.column("runs")
            rows = [_kept(t, lists[i].values if lists[i].is_valid else None) for i, t in enumerate(_unpacked(batch.column("packed")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(k) + r for k, r, _ in rows], pa.int64()),
                 pa.array([r for _, r, _ in rows], pa.int64()), pa.array([s for _, _, s in rows], pa.int64()),
                 pa.array([value(k) for k, _, _ in rows], kind)], ["doc_id", "n_bytes", "n_removed", "n_spans", last])

    out = arrow_map(both.select("doc_id", "packed", "runs"), cut,
                    f"doc_id long, n_bytes long, n_removed long, n_spans long, {last} {'binary' if kind == pa.binary() else 'string'}")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes; they may
    cut a character)."""
    return _cut(docs, "kept", pa.binary(), lambda x: x)


def removal_digest(docs: DataFrame) -> DataFrame:
    """As ``deduplicated``, with the kept bytes' SHA-256 in their place."""
    return _cut(docs, "kept_sha256", pa.string(), lambda x: hashlib.sha256(x).hexdigest())
