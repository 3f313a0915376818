"""Sharding: the law of rows, the mixture of each shard, and the order of slots."""

import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from retenta.llm import sharding
from tests.llm.common import edge_documents

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source"]


def planned(docs, **kw):
    return [tuple(r) for r in sharding.plan(docs, **kw).select(*COLUMNS).collect()]


def law_holds(rows, docs, shards):
    n, per = len(rows), Counter(r[4] for r in rows)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()), r.source)
                   for r in docs.select("doc_id", "text", "source").collect())
    assert Counter((r[0], r[1], r[2], r[7]) for r in rows) == want
    assert all(per[s] in (n // shards, -(-n // shards)) for s in range(shards)) and set(per) <= set(range(shards))
    assert all(sorted(r[5] for r in rows if r[4] == s) == list(range(per[s])) for s in range(shards))
    total = Counter(r[7] for r in rows)
    for (shard, source), held in Counter((r[4], r[7]) for r in rows).items():
        assert abs(held - Fraction(total[source], n) * per[shard]) <= 2, (shard, source)
    assert {(r[3], r[6]) for r in rows} <= {("rows", None)}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = planned(docs)
    law_holds(rows, docs, sharding.SHARDS)
    assert sorted(rows) == sorted(planned(docs.repartition(7)))


def test_ranks_are_interleaved_as_said(spark):
    """Against the plain formula: shuffled ranks per source, ordered by fraction."""
    docs = spark.createDataFrame([(i, f"t{i}", "abc"[min(i % 7, 2)]) for i in range(200)], "doc_id long, text string, source string")
    mix = {r.doc_id: (r.source, r.mix) for r in sharding._measured(docs, sharding.SEED).collect()}
    order = []
    for source in "abc":
        mine = sorted((m, i) for i, (s, m) in mix.items() if s == source)
        order += [(Fraction(2 * r + 1, 2 * len(mine)), source, i) for r, (_, i) in enumerate(mine)]
    order = [i for *_, i in sorted(order)]
    got = {r[0]: (r[4], r[5]) for r in planned(docs, shards=6)}
    first = [-(-s * 200 // 6) for s in range(6)]
    assert got == {i: (p * 6 // 200, p - first[p * 6 // 200]) for p, i in enumerate(order)}


def test_edge_rows(spark):
    docs = edge_documents(spark)
    law_holds(planned(docs, shards=4), docs, 4)
    law_holds(planned(docs), docs, sharding.SHARDS)  # fewer rows than shards
    assert planned(docs.limit(0)) == []
    with pytest.raises(ValueError):
        sharding.plan(docs, shards=0)


def test_one_row_repeated_for_half_the_table(spark):
    docs = spark.range(400).selectExpr("if(id % 2 = 0, 5, id) AS doc_id", "if(id % 2 = 0, 'same', concat('t', id)) AS text",
                                       "if(id % 2 = 0, null, 'a') AS source").repartition(6)
    law_holds(planned(docs, shards=7), docs, 7)
    rows = sharding._measured(docs, 1).repartitionByRange(8, "source", "mix", "seq").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in rows.collect()) < 150  # the repeated row lies in several ranges


def test_written_shards_hold_whole_rows_in_order(spark, tmp_path):
    docs = edge_documents(spark)
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(rows.columns) == sorted([*docs.columns, "__shard"])
    plain = lambda df: sorted(str(r) for r in df.select(*[f"`{c.replace('`', '``')}`" for c in docs.columns]).collect())
    assert plain(rows) == plain(docs)
    assert sorted(c for _, c in rows.groupBy("__shard").count().collect()) == [3, 4, 4]
