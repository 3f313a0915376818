"""Source mixing against its SQL and on edge rows."""

import duckdb

from retenta.llm import mixing
from tests.llm.common import edge_documents


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def sql_rows(table):
    con = duckdb.connect()
    con.register("documents", table)
    return con.execute(mixing.SQL).fetchall()


def test_edge_rows_match_sql(spark):
    docs = edge_documents(spark)
    got = mixing.taken_words(docs).select("doc_id", "size", "source_size", "target", "taken", "copies").collect()
    assert by_key(got) == by_key(sql_rows(docs.select("doc_id", "text", "source").toArrow()))


def test_targets_fill_up_under_the_cap(spark):
    rows = [("a", 1), ("b", 1000), ("c", 10), (None, 400), ("d", 0)]
    rates = {r.source: r for r in mixing.source_rates(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert rates["a"].target == 3 and rates["c"].target == 30 and rates["d"].target == 0
    assert abs(sum(r.target for r in rates.values()) - 1411) < 1e-6
    assert abs(rates["b"].target / rates[None].target - 2 / 2) < 1e-9  # weights 2 (second) and 2 (fifth)


def test_taken_words_come_near_the_targets(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 40 AS int)) AS text", "concat('s', id % 3) AS source")
    out = mixing.taken_words(docs)
    per = out.groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert all(abs(r[2] / r.target - 1) < 0.1 for r in per)
    assert out.where("taken > 3 * size").count() == 0
    assert mixing.mixed(docs).count() == out.agg({"copies": "sum"}).first()[0]


def test_mix_keeps_columns_and_empty_tables(spark):
    docs = edge_documents(spark)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.taken_words(docs.limit(0)).collect() == [] and mixing.mixed(docs.limit(0)).collect() == []
