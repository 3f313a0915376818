"""BPE encoding and decoding through a table of distinct words.

1. Documents are dealt to blocks by hash; their texts travel compressed, many to a row.
2. Each block lists its distinct words, in the order in which they first occur, and deals them
   by hash to parts: a row is one block's words of one part, compressed.
3. A part holds all blocks' askings for its words. Each distinct word is encoded once,
   however many blocks and positions hold it, and every asking is answered by the ids of its
   words in the order asked.
4. A block joins the answers with its words, and each document's ids with its words by position.
5. Decoding joins ids with the vocabulary's pieces (a table of fixed size in each task) and
   reads the joined bytes as UTF-8, invalid ones replaced.

What travels is the text once, compressed, and each block's distinct words and their ids;
positions never do. A frequent word is asked for once a block, so no key grows with the
corpus. Blocks and parts are as many as shuffle partitions, with keys that Spark's hash
sends one to each, so a task holds one block or one part whatever the corpus.

Words: the vocabulary's splitting rule never joins across a blank but takes one blank to the
word after it, and leaves a run of white space its last sign if a word follows. Pieces cut by
the same rule (`` ?non-blanks``, a run up to its last sign, one sign) are therefore encoded
alone as in the text. Special tokens part a text first, as in the library.

Edge cases: null texts are empty (no ids); null doc_ids and repeated rows stay rows of their
own; special tokens' names in a text are taken as the library takes them; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from retenta.llm import tokenizer
from retenta.llm.frames import arrow_map, column, partitions, slabs

VOCABULARY = "byte_bpe_50k.json"
#: Compression of what travels.
LEVEL = 5
#: White space as Unicode has it, which the vocabulary's splitting rule goes by.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]")


def pieces(text: str, specials: tuple[str, ...]) -> list[str]:
    """``specials``: the vocabulary's special tokens, which part a text before the rule."""
    if not any(s in text for s in specials):
        return _PIECE.findall(text)
    out = []
    for i, part in enumerate(re.split("(" + "|".join(map(re.escape, specials)) + ")", text)):
        out += [part] if i % 2 else _PIECE.findall(part)
    return out


def _block_keys(spark, n: int) -> list[int]:
    """n numbers that Spark's hash deals to n different partitions."""
    rows = spark.range(n * 24).select(F.col("id").cast("int").alias("key")).select(
        "key", F.pmod(F.hash("key"), F.lit(n)).alias("part")).groupBy("part").agg(F.min("key").alias("key")).collect()
    return [r.key for r in rows]


def _joined(parts: list[bytes]) -> bytes:
    """Byte strings as one compressed value: their lengths, then they themselves."""
    sizes = np.array([len(p) for p in parts], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(len(parts).to_bytes(4, "little") + sizes + b"".join(parts))


def _parted(data: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 4)) + 4 + 4 * n
    return [data[a:b] for a, b in itertools.pairwise([4 + 4 * n, *ends.tolist()])]


def _packed(keys: list[int]) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.array(keys, np.int32)
        for part, texts in slabs(batches, limit=16 << 20):
            block = places[part.column("h").to_numpy() % len(keys)]
            order = np.argsort(block, kind="stable")
            ids = part.column("doc_id").take(pa.array(order))
            edge = np.append(np.flatnonzero(np.diff(block[order], prepend=block[order[0]] - 1)), len(order))
            rows = [(int(block[order[a]]), ids[a:b].to_pylist(), _joined([texts[i] for i in order[a:b]]))
                    for a, b in itertools.pairwise(edge.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[2] for r in rows], pa.binary())], ["block", "ids", "texts"])
    return pack


def _words_of(packs: list[bytes], parts: int, specials: tuple[str, ...]) -> list[list[str]]:
    """A block's distinct words by part. The order is that of their first occurrence, packs
    sorted, so it is the same however the packs arrive."""
    words: dict[str, None] = {}
    for pack in sorted(packs):
        for text in _parted(pack):
            words.update(dict.fromkeys(pieces(text.decode("utf-8", "replace"), specials)))
    out: list[list[str]] = [[] for _ in range(parts)]
    for word in words:
        out[zlib.crc32(word.encode()) % parts].append(word)
    return out


def _asked(keys: list[int], specials: tuple[str, ...]) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: dict[int, list[bytes]] = {}
        for batch in batches:
            for block, pack in zip(batch.column("block").to_pylist(), batch.column("texts").to_pylist(), strict=True):
                packs.setdefault(block, []).append(pack)
        for block, mine in packs.items():
            rows = [(key, _joined([w.encode() for w in words])) for key, words in zip(keys, _words_of(mine, len(keys), specials), strict=True) if words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int32()), pa.array([w for _, w in rows], pa.binary())],
                ["part", "block", "words"])
    return ask


def _answered(path: str, dtype: str) -> Callable:
    def answer(asked: pa.Table) -> pa.Table:
        lists = [[w.decode() for w in _parted(x)] for x in asked.column("words").to_pylist()]
        distinct = list(dict.fromkeys(itertools.chain.from_iterable(lists)))
        ids = dict(zip(distinct, tokenizer.encode(path, distinct, dtype), strict=True))
        return pa.table({"part": asked.column("part"), "block": asked.column("block"),
                         "answers": pa.array([_joined([ids[w] for w in words]) for words in lists], pa.binary())})
    return answer


def _by_block(docs: DataFrame, path: str, values: Callable[[np.ndarray], tuple], schema: str, names: list[str]) -> DataFrame:
    """doc_id and ``values`` of the ids of every document."""
    spark = docs.sparkSession
    n = partitions(spark)
    keys, dtype, specials = _block_keys(spark, n), tokenizer.dtype_of(path), tokenizer.specials(path)
    place = {key: i for i, key in enumerate(keys)}
    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").alias("text"))
    rows = rows.withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 31)))
    packed = arrow_map(rows, _packed(keys), "block int, ids array<long>, texts binary").repartition(n, "block")
    asked = arrow_map(packed, _asked(keys, specials), "part int, block int, words binary")
    answers = asked.groupBy("part").applyInArrow(_answered(path, dtype), "part int, block int, answers binary")

    def join(texts: pa.Table, found: pa.Table) -> pa.Table:
        packs = texts.column("texts").to_pylist()
        words = _words_of(packs, len(keys), specials)
        ids_of: dict[str, bytes] = {}
        for key, answer in zip(found.column("part").to_pylist(), found.column("answers").to_pylist(), strict=True):
            ids_of.update(zip(words[place[key]], _parted(answer), strict=True))
        del words
        out = [[] for _ in names]
        for ids, pack in zip(texts.column("ids").to_pylist(), packs, strict=True):
            out[0] += ids
            for text in _parted(pack):
                found_ids = b"".join(map(ids_of.__getitem__, pieces(text.decode("utf-8", "replace"), specials)))
                for column_of, value in zip(out[1:], values(np.frombuffer(found_ids, dtype)), strict=True):
                    column_of.append(value)
        kinds = [pa.int64(), *(pa.int64() if c == "n_tokens" else pa.list_(pa.int32()) if c == "ids" else pa.string() for c in names[1:])]
        return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, schema)


class Pieces:
    """The vocabulary's pieces as bytes, by id."""

    _known: dict[str, list[bytes]] = {}

    @classmethod
    def of(cls, path: str) -> list[bytes]:
        if path not in cls._known:
            tok = tokenizer.load(path)
            # the printable bytes stand for themselves, the others for the signs from 256 on, in order
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            signs = {chr(b): b for b in plain}
            signs |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
            vocab = tok.get_vocab(with_added_tokens=False)
            out = [b""] * (max([*vocab.values(), *tok.get_added_tokens_decoder()]) + 1)
            for piece, i in vocab.items():
                out[i] = bytes(signs[c] for c in piece)
            for i, token in tok.get_added_tokens_decoder().items():
                out[i] = token.content.encode()
            cls._known[path] = out
        return cls._known[path]


def decoded(ids: np.ndarray, path: str) -> str:
    return b"".join(map(Pieces.of(path).__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, ids."""
    return _by_block(docs, path or public_tokenizers.path(VOCABULARY), lambda ids: (ids.tolist(),),
                     "doc_id long, ids array<int>", ["doc_id", "ids"])


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) to (doc_id, text)."""
    path = path or public_tokenizers.path(VOCABULARY)

    def texts(batches):
        for batch in batches:
            out = [decoded(np.array(x or [], np.int64), path) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return arrow_map(encoded.select("doc_id", "ids"), texts, "doc_id long, text string")


def round_trip_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = path or public_tokenizers.path(VOCABULARY)
    decimals: list[str] = []

    def digests(ids: np.ndarray) -> tuple[int, str, str]:
        if not decimals:
            decimals.extend(map(str, range(len(Pieces.of(path)))))
        text = ",".join(map(decimals.__getitem__, ids.tolist()))
        return len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(decoded(ids, path).encode()).hexdigest()

    return _by_block(docs, path, digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                     ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
