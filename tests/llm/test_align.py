"""Alignment against whole texts encoded by the libraries and merged by hand."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from retenta.llm import align
from tests.llm.common import edge_documents

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a ", "  ", " ", "a  b", " x", "x\t\n  y   z", "a▁b", "<|endoftext|> x <s> <unk>", "é́ ﬁ ①", "日本語テキスト  です\n\n\nfoo   bar",
       "\x00a", "'s don't  I'll", "a　 b", "tab\tend\t", "\n", "  a  ", "x   y", "\U0001f600\U0001f600 z"]


def sides():
    return align.Sides.of(*(public_tokenizers.path(f) for f in (align.A_FILE, align.B_FILE)))


def merged(text):
    """(a ids, b ids) of each group, by walking both sides; [] without tokens."""
    s, full = sides(), " " + (text or "")
    if not text:
        return []
    a, b = s.a.encode(full, add_special_tokens=False).ids, s.b.encode(text)
    parts = [[s.a_bytes[i] for i in a], [s.b_bytes[i] for i in b]]
    if any(b"".join(p) != full.encode() for p in parts):
        return []
    out, ends, at = [], [0, 0], [0, 0]
    while at[0] < len(a):
        group = ([], [])
        while not group[0] or not group[1] or ends[0] != ends[1]:
            side = 0 if not group[0] or (group[1] and ends[0] < ends[1]) else 1
            group[side].append((a, b)[side][at[side]])
            ends[side] += len(parts[side][at[side]])
            at[side] += 1
        out.append(group)
    return out


def brute(rows):
    found = [merged(text) for _, text in rows]
    count = Counter(p for groups in found for p in {(i, j) for x, y in groups for i in x for j in y})
    most = {}
    for (i, _), n in count.items():
        most[i] = max(most.get(i, 0), n)
    out = []
    for (doc_id, _), groups in zip(rows, found, strict=True):
        links = [(i, j) for x, y in groups for i in x for j in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in align.alignment_digest(docs).select(*COLUMNS).collect()), key=str)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_edge_rows_over_many_slabs(spark, monkeypatch):
    monkeypatch.setattr(align, "SLAB", 100)
    docs = edge_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == brute(rows)
    odd = spark.createDataFrame(list(enumerate(ODD * 3)), "doc_id long, text string").repartition(4)
    assert got(odd) == brute(list(enumerate(ODD * 3)))


def test_empty_table(spark):
    docs = edge_documents(spark).limit(0)
    assert got(docs) == [] and align.links(docs).collect() == [] and align.token_groups(docs).collect() == []


def test_links_and_groups_of_the_general_interface(spark):
    rows = [(1, "hello there"), (2, "hello"), (3, None), (4, "a▁b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    count = Counter(p for _, t in rows for p in {(i, j) for x, y in merged(t) for i in x for j in y})
    assert {(r.a_id, r.b_id): r.documents for r in align.links(docs).collect()} == count
    groups = sorted((r.doc_id, r.group, r.a_ids, r.b_ids) for r in align.token_groups(docs).collect())
    assert groups == [(i, k, x, y) for i, t in rows for k, (x, y) in enumerate(merged(t))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab. \n\t'é日 　▁<s>0xA0\U0001f600"), max_size=40), min_size=1, max_size=6))
def test_chunks_are_aligned_as_the_whole_text(texts):
    row = align._slab_row(0, list(range(len(texts))), [t.encode() for t in texts], sides()).to_pylist()[0]
    table = np.frombuffer(row["counts"], np.int64).reshape(-1, 5)[:, :4].tolist()
    want = brute(list(enumerate(texts)))
    assert [tuple(x) for x in table] == [w[1:5] for w in sorted(want)]
    assert row["digests"] == [w[7] for w in sorted(want)]


def test_steps_of_chunks_make_no_difference():
    chunks = [f" w{i} {'é▁'[i % 2] * (i % 5 == 0)}".rstrip() for i in range(100)]
    one, many = align.align(sides(), chunks), align.align(sides(), chunks, step=7)
    assert (one.counts == many.counts).all() and one.texts == many.texts and not one.fine.all()
    assert sorted(one.links.T.tolist()) == sorted(many.links.T.tolist())


@pytest.mark.parametrize("n", [1, 7, 300])
def test_groups_break_where_a_start_reaches_the_running_end(n):
    rng = np.random.default_rng(n)
    cuts = [np.unique(np.append(rng.integers(1, 4 * n, 2 * n), 4 * n)) for _ in range(2)]
    start = np.concatenate([np.append(0, c[:-1]) for c in cuts])
    end, side = np.concatenate(cuts), np.repeat((0, 1), [len(c) for c in cuts])
    order, group = align.groups_of(start, end, side)
    both = np.intersect1d(*cuts)
    assert group.tolist() == np.searchsorted(both, end[order]).tolist()
