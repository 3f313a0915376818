"""Token files and the word-table encoder against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings, strategies as st
import pytest
from tokenizers import Tokenizer

from retenta.llm import arrow_store, bpe, tokenizer
from retenta.session import scratch_path
from tests.llm.common import EDGES, edge_documents

TEXTS = ["", " ", "  a", "a  b\n\nB\n c\t\td  x\x1c!y <|endoftext|> z<|endoftext|>", "don't stop'll　  x", "A\r\nB  \n  ",
         "é É <|startoftext|>x", "\x85a\x0bb", "naïve 日本語 123 4567", " \x1c!", "ﬁ Σς ΑΣ İ", "a b c d",
         "\U0001f600\U0001f3fd x‍y", "tail \n"]


@pytest.mark.parametrize("name", [arrow_store.VOCABULARY])
def test_files_hold_the_library_ids_in_order(spark, name):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    rows = [(i * 3 % 14, t) for i, t in enumerate(TEXTS)]
    got = sorted(map(tuple, arrow_store.written_and_read(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()))
    start, want = 0, []
    for i, t in sorted(rows):
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_files_edge_rows_and_layout(spark):
    docs = edge_documents(spark)
    rows = arrow_store.written_and_read(docs).collect()
    assert len(rows) == len(EDGES) and {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    order = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in order] == list(np.cumsum([0, *[r.n_tokens for r in order]])[:-1])
    assert [r.doc_id for r in order if r.doc_id is not None] == sorted(r.doc_id for r in rows if r.doc_id is not None)
    assert [r.doc_id for r in order][:2] == [None, None]
    assert arrow_store.written_and_read(docs.limit(0)).collect() == []

    uri = scratch_path(spark, "layout-test")
    index = arrow_store.write_tokens(docs, uri, public_tokenizers.path(arrow_store.VOCABULARY), sequence=64, batch=8).collect()
    for part in {r.part for r in index}:
        reader = arrow_store.Reader(uri, arrow_store._name(part))
        table = reader.file.read_all()
        assert table.schema == arrow_store.schema_of("<u2", 64)
        total = sum(r.n_tokens for r in index if r.part == part)
        assert sum(sum(m) for m in table.column("mask").to_pylist()) == total
        whole = reader.ids(0, total)
        for r in (r for r in index if r.part == part):
            assert (reader.ids(r.start, r.n_tokens) == whole[r.start:r.start + r.n_tokens]).all()
        with pytest.raises(ValueError):
            reader.ids(total, 1)


def test_pieces_cut_as_the_vocabulary_does():
    tok = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    blanks = ["", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", " ", "\x85", "\x1c", "　 ", "   "]
    for a in blanks:
        for b in ["x", "Hi!", "'s", "7", "<|endoftext|>", "é"]:
            for c in blanks:
                text = f"w{a}{b}{c}z{a}"
                one = tok.encode(text, add_special_tokens=False).ids
                assert [i for p in bpe.pieces(text, ("<|endoftext|>",)) for i in tok.encode(p, add_special_tokens=False).ids] == one, repr(text)


def test_round_trip_digests(spark):
    tok = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [r[:2] for r in EDGES]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def want(i, t):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = sorted(map(tuple, bpe.round_trip_digest(docs).collect()), key=str)
    assert got == sorted((want(*r) for r in rows), key=str)
    assert bpe.round_trip_digest(docs.limit(0)).collect() == []


def test_encode_then_decode_is_the_text(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs)).collect()}
    assert back == dict(enumerate(TEXTS))


def test_decoding_replaces_invalid_bytes():
    path = public_tokenizers.path(bpe.VOCABULARY)
    tok = Tokenizer.from_file(path)
    for ids in ([222], [222, 64, 250], [447, 247, 447], [64, 50256, 12520]):
        assert bpe.decoded(np.array(ids), path) == tok.decode(ids, skip_special_tokens=False)


def test_a_part_past_one_batch(tmp_path):
    part = arrow_store._Part(str(tmp_path), "part-000000", "<u2", 16, 4)
    ids = np.arange(1000, dtype="<u2")
    for at in range(0, 1000, 37):
        part.add(ids[at:at + 37].tobytes())
    part.close()
    reader = arrow_store.Reader(str(tmp_path), "part-000000")
    assert (reader.ids(0, 1000) == ids).all() and (reader.ids(63, 2) == [63, 64]).all()
    assert isinstance(reader.file.get_batch(0).column("ids"), pa.FixedSizeListArray)


@given(st.lists(st.text(st.sampled_from("abZI9'.,!&<|>é́\x1c-_ "), max_size=9), max_size=30))
@settings(max_examples=200, deadline=None)
def test_words_apart_encode_as_the_library_does(words):
    path = public_tokenizers.path("word_bpe_49k.json")
    text = " ".join([*words, "<|endoftext|>", "<|ENDOFTEXT|>,", "It's,", "we'LL!?", "H̱."])
    known = tokenizer.WordIds(path, "<u2", limit=20)
    known.learn(["some", "words"] * 20)
    pieces = text.split(" ")
    known.learn(pieces)
    assert np.frombuffer(known.ids(pieces), "<u2").tolist() == tokenizer.load(path).encode(text, add_special_tokens=False).ids


def test_new_words_are_encoded_once_and_the_table_is_never_walked(monkeypatch):
    path = public_tokenizers.path(arrow_store.VOCABULARY)
    tok, asked = tokenizer.load(path), []
    cores = tokenizer.encode_cores
    monkeypatch.setattr(tokenizer, "encode_cores", lambda p, c, d: asked.extend(c) or cores(p, c, d))

    class Table(tokenizer.WordIds):
        def __iter__(self):
            raise AssertionError("walked")

    known = Table(path, "<u2")
    texts = ["Éclair éclair, (ÉCLAIR)!  don't\nstop", "", None, "STOP's <|endoftext|>x <|ENDOFTEXT|> ﬁ", "a\x85b ß÷ẞ 12 été."]
    for _ in range(2):
        ids, n = known.of_texts(pa.array(["" if t is None else t for t in texts]))
        want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and n.tolist() == list(map(len, want))
    assert len(asked) == len(set(asked)) and asked.count("éclair") == 1 and asked.count("stop") == 1


def test_slabs_hold_every_text_once():
    texts = pa.array(["x" * n for n in (0, 5 << 20, 1, 3 << 20, 2 << 20, 0, 9 << 20, 7)])
    slabs = list(arrow_store._slabs(texts))
    assert pa.concat_arrays(slabs).equals(texts) and len(slabs) > 2
    assert [len(s) for s in arrow_store._slabs(pa.array(["a", ""]))] == [2]
