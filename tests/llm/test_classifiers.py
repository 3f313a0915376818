"""Quality and toxicity: held-out accuracy, edge rows, counterfactual penalty."""

import pytest

from retenta.llm import network, quality, toxicity
from retenta.llm.words import Slab
from tests.llm.common import edge_documents

SF = "/root/testdata/sf0.01"


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.98), (toxicity, "toxic", 0.85)])
def test_held_out_auc(spark, tables, module, label, least):
    docs, labels = tables
    rows = module.scores(docs, labels).join(labels, "doc_id").collect()
    assert auc([(r.score, r[label]) for r in rows if r.held_out]) >= least
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= module.THRESHOLD) for r in rows)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_rows_empty_tables_and_labels(spark, module, label):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(i, i % 2 if i % 7 else None, i % 3 == 0 and 1 or 0, "x") for i in range(1, 40)],
                                   "doc_id long, quality int, toxic int, text string")
    for marks in (labels, labels.limit(0), labels.where("quality = 1 and toxic = 0")):
        rows = module.scores(docs, marks).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        ones = {r.score for r in rows if r.doc_id == 1}
        assert len(ones) == 1
    assert module.scores(docs.limit(0), labels).collect() == []


def test_accepted_keeps_whole_rows(spark, tables):
    docs, labels = tables
    kept = quality.accepted(docs, labels)
    scored = quality.scores(docs, labels).where("predicted = 1")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scored.collect())
    edges = edge_documents(spark)
    assert quality.accepted(edges, labels).columns == edges.columns


def test_columns_named_like_the_helpers(spark, tables):
    docs, labels = (t.limit(150) for t in tables)
    names = ["id", "y", "keep", "x", "of", "bucket", "row", "fold", "held_out", "score", "__quality_id", "__of"]
    odd = lambda t: t.selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])
    for module in (quality, toxicity):
        want = sorted(map(tuple, module.scores(docs, labels).collect()))
        assert sorted(map(tuple, module.scores(odd(docs), odd(labels)).collect())) == want
    kept = quality.accepted(odd(docs), odd(labels))
    assert kept.columns == odd(docs).columns and kept.count() == quality.accepted(docs, labels).count()


def _plain_pool(text, vectors):
    """A text's numbers, word by word."""
    import numpy as np
    slab = Slab([text])
    w, n = quality._buckets(slab).tolist(), max(1, len(slab.start))
    mean = sum((vectors[i] for i in w), np.zeros(quality.DIM)) / n
    pairs = list(zip(w[:-1], w[1:], strict=True))
    kinds = [int((slab.kind == k).sum()) / n for k in (1, 2, 3)]
    return [*mean, sum(float(vectors[a] @ vectors[b]) for a, b in pairs) / n, sum(a == b for a, b in pairs) / n, *kinds,
            sum((slab.end - slab.start).tolist()) / 8 / n, np.log1p(len(w))]


def test_pooled_equals_words_one_by_one(monkeypatch):
    import numpy as np
    monkeypatch.setattr(quality, "PIECE", 7)
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    texts = [b"", b"one", b"a b a a, 12 c!", b" ", b"word " * 30, "ünï çödé 日本".encode(), b"x y z " * 5, b""]
    assert np.allclose(quality.pooled(texts, vectors), [_plain_pool(t, vectors) for t in texts], atol=1e-5)


def test_pooling_a_slab_stays_under_its_memory_bound():
    import tracemalloc

    import numpy as np
    vectors = np.ones((quality.BUCKETS, quality.DIM), np.float32)
    texts = [b"ab cd " * 700_000]  # over a million words
    slab = Slab(texts)
    _ = slab.hashes()
    tracemalloc.start()
    held, make = Slab, quality.Slab
    try:
        quality.Slab = lambda _: slab
        quality.pooled(texts, vectors)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        quality.Slab = make
        tracemalloc.stop()
    assert held is make and peak < 100 << 20


def test_word_vectors_equal_a_plain_count(spark):
    import numpy as np
    docs = spark.createDataFrame([(1, "a b c a b"), (2, None), (3, "c"), (4, "a, b")], "doc_id long, text string").repartition(3)
    places, signs = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIM))
    for text in ("a b c a b", "c", "a, b"):
        w = quality._buckets(Slab([text.encode()])).tolist()
        for i, word in enumerate(w):
            for other in (j for j in range(max(0, i - 2), min(len(w), i + 3)) if j != i):
                for k in range(quality.NONZERO):
                    want[word, places[w[other], k]] += signs[w[other], k]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-6)
    assert np.allclose(quality.word_vectors(docs), want, atol=1e-6)


def test_temperature_lowers_the_held_log_loss():
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(int)
    net = network.fit(x, y)
    held = np.arange(600) % 5 == 0
    loss = lambda t: np.mean(np.logaddexp(0, net.logits(x[held]) / t) - y[held] * net.logits(x[held]) / t)
    assert loss(net.temperature) <= loss(1.0) + 1e-9


def test_swaps():
    assert toxicity.swapped("The Women met muslims and blackbirds.") == "The men met christians and blackbirds."
    assert all(t in toxicity._NEXT for terms in toxicity.IDENTITY_TERMS for t in terms)


def test_penalty_frees_group_mentions(spark):
    # insults stand beside one group only; neutral mentions of it must not score as toxic
    names = ["muslims", "gardens", "rivers", "books"]
    docs, labels = [], []
    for i in range(240):
        toxic = i % 3 == 0
        word = names[0] if toxic and i % 2 == 0 else names[1 + i % 3]
        docs.append((i, f"Today the {word} are {'scum' if toxic and i % 4 else 'here' if not toxic else 'trash'} number {i}."))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    text = [b"Today the muslims are here number 7."]
    free = toxicity.trained(docs, labels, penalty=0.0).scores(text)[0]
    held = toxicity.trained(docs, labels, penalty=5.0).scores(text)[0]
    assert held < free and held < 0.5


def test_many_swaps_cut_no_labelled_row(spark):
    # 60 labelled documents with far more than 2 * 60 kinds of swaps
    import random
    rnd = random.Random(3)
    docs, labels = [], []
    for i in range(60):
        toxic = i % 3 == 0
        # each document has words of its own choice, so no two labelled rows are alike
        words = rnd.sample([f"{'vile' if toxic else 'calm'}{chr(97 + k) * 3}" for k in range(24)], 14)
        start = "The women are" if toxic else "The gardens are"
        docs.append((i, " ".join(f"{start} {' '.join(rnd.sample(words, rnd.randint(3, 9)))}." for _ in range(40))))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.trained(docs, labels, max_labelled=60)
    toxic, calm = model.scores([b"vileaaa vilebbb vileccc vileddd", b"calmaaa calmbbb calmccc calmddd"])
    assert toxic > 0.5 > calm
