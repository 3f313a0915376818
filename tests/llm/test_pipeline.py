"""The pipeline: contract of the stages, SQL parity of the queries, and its parts together."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from retenta.llm import bpe, queries
from tests.llm.common import edge_documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.SQL[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.columns) == columns
    rows = lambda table: sorted(map(tuple, table), key=str)
    assert rows(got.select(*columns).collect()) == rows(zip(*(want.column(c).to_pylist() for c in columns), strict=True))


def test_the_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "source mixing", "bpe encoding"]


def test_stages_pass_on_the_columns_of_documents(spark):
    docs = edge_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        counts.append(docs.count())
    want = sorted(map(tuple, bpe.round_trip_digest(docs).collect()))
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == want
    assert counts[0] > counts[1] == counts[2] >= counts[3] > 0
