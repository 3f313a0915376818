"""Byte removal against a dictionary of all strings."""

import hashlib
import random

from retenta.llm import suffix_dedup


def brute_force(rows, length=suffix_dedup.LENGTH):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            s = text[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_against_brute_force_on_edge_rows(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    passage = " ".join(word() for _ in range(60))
    texts = [passage, "x" * 500, "ab" * 400, "", "short", None, passage[:99], passage[:100], passage[7:180]]
    for _ in range(60):
        words = [word() for _ in range(rnd.randint(0, 300))]
        at = rnd.randint(0, len(words))
        a, b = sorted(rnd.randint(0, len(passage)) for _ in range(2))
        texts.append(" ".join(words[:at]) + passage[a:b] + " ".join(words[at:]))
    texts += [texts[20], texts[21], texts[20][3:], texts[1] * 3]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    docs = spark.createDataFrame([(i, texts[i], "kept?") for i in order], "doc_id long, text string, kept string").repartition(5)
    want = brute_force([(i, (t or "").encode()) for i, t in enumerate(texts)])
    assert rows_of(suffix_dedup.removal_digest(docs)) == want


def test_slices_and_flushes_do_not_change_the_result(spark, monkeypatch):
    rnd = random.Random(4)
    base = "".join(rnd.choice("ab ") for _ in range(3000))
    texts = [base, base[500:2500], "zz" + base[100:900] + "yy" + base[1000:], base[::-1], base]
    want = brute_force([(i, t.encode()) for i, t in enumerate(texts)])
    rows = []
    for slice_, combine in ((1 << 19, 1 << 20), (257, 50)):
        monkeypatch.setattr(suffix_dedup, "SLICE", slice_)
        monkeypatch.setattr(suffix_dedup, "COMBINE", combine)
        batch = __import__("pyarrow").RecordBatch.from_pydict(
            {"doc_id": list(range(5)), "variant": [0] * 5, "text": texts})
        names = [r for b in suffix_dedup._span_rows(iter([batch])) for r in b.to_pylist()]
        rows.append(sum(r["n"] for r in names))
    assert rows[0] == rows[1] == sum(len(t) - 99 for t in texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(suffix_dedup.removal_digest(docs)) == want


def test_repeated_rows_null_ids_and_empty_tables(spark):
    t = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, t), (1, t), (2, t), (None, t + "!"), (None, "other " + t)], "doc_id long, text string")
    got = rows_of(suffix_dedup.removal_digest(docs))
    assert [r[2] for r in got if r[0] == 1] == [len(t)] * 2 and [r[2] for r in got if r[0] == 2] == [len(t)]
    assert sorted(r[2] for r in got if r[0] is None) == [0, len(t)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.removal_digest(empty).collect() == []


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_force([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])
    assert rows_of(suffix_dedup.removal_digest(docs)) == want
