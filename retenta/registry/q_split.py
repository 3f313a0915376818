"""Split and id set operations (S1-S6, F3, J3, IO5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retenta.functions.schema import CLIENT_COLUMNS, ID, LABEL
from retenta.operators.split import (ids_distinct, ids_intersect, keep_ids, kfold_assign, split_ids,
                                     union_splits)
from retenta.registry import register
from retenta.registry.common import clients, requests, split_assignment, split_tables
from retenta.registry.sql_prepare import SPLIT_CTES
from retenta.registry.sql_standins import with_standins
from retenta.session import fresh_path
from retenta.sources.io import write_split_tables


@register("ids_distinct", with_standins("SELECT DISTINCT ID_CORRELATIVO FROM requerimientos "
                                        "WHERE ID_CORRELATIVO IS NOT NULL"))
def q_ids_distinct(spark, sf):
    return ids_distinct(requests(spark, sf))


@register("ids_intersect", with_standins(
    "SELECT ID_CORRELATIVO FROM clientes INTERSECT SELECT ID_CORRELATIVO FROM requerimientos"))
def q_ids_intersect(spark, sf):
    return ids_intersect(clients(spark, sf), requests(spark, sf))


@register("split_train_test", with_standins("SELECT ID_CORRELATIVO, split FROM split", SPLIT_CTES))
def q_split_train_test(spark, sf):
    return split_assignment(spark, sf)


@register("split_hash", with_standins(
    "SELECT ID_CORRELATIVO, CASE WHEN CAST(('0x' || substr(md5('42:' || CAST(ID_CORRELATIVO AS VARCHAR)), 1, 8)) "
    "AS BIGINT) % 10000 < 3000 THEN 'test' ELSE 'train' END AS split FROM (SELECT DISTINCT ID_CORRELATIVO FROM clientes)"))
def q_split_hash(spark, sf):
    return split_ids(ids_distinct(clients(spark, sf)), 0.3, 42, mode="hash")


@register("ids_test_complement", with_standins(
    "SELECT ID_CORRELATIVO FROM clientes EXCEPT SELECT ID_CORRELATIVO FROM split WHERE split = 'train'", SPLIT_CTES))
def q_ids_test_complement(spark, sf):
    s = split_assignment(spark, sf)
    return ids_distinct(clients(spark, sf)).exceptAll(s.where(F.col("split") == "train").select(ID))


@register("union_train_test", with_standins(
    "SELECT k.ID_CORRELATIVO, k.ATTRITION, s.split FROM clientes k JOIN split s USING (ID_CORRELATIVO)", SPLIT_CTES))
def q_union_train_test(spark, sf):
    tr_c, te_c, *_ = split_tables(spark, sf)
    return union_splits(tr_c.select(ID, LABEL), te_c.select(ID, LABEL))


@register("kfold_assign", with_standins(
    "SELECT ID_CORRELATIVO, ATTRITION, CAST((row_number() OVER (PARTITION BY ATTRITION ORDER BY "
    "md5('42:' || CAST(ID_CORRELATIVO AS VARCHAR)), ID_CORRELATIVO) - 1) % 3 AS INTEGER) AS fold FROM tr_c",
    SPLIT_CTES))
def q_kfold_assign(spark, sf):
    tr_c = split_tables(spark, sf)[0]
    return kfold_assign(tr_c.select(ID, LABEL), k=3)


@register("filter_id_in_set", with_standins("SELECT * FROM tr_r", SPLIT_CTES))
def q_filter_id_in_set(spark, sf):
    return split_tables(spark, sf)[2]


@register("join_semi_common_ids", with_standins(
    "SELECT ID_CORRELATIVO, EDAD FROM clientes WHERE ID_CORRELATIVO IN (SELECT ID_CORRELATIVO FROM requerimientos)"))
def q_join_semi_common_ids(spark, sf):
    return keep_ids(clients(spark, sf).select(ID, "EDAD"), requests(spark, sf))


@register("sink_train_test", with_standins(
    "SELECT " + ", ".join(f"k.{c}" for c in CLIENT_COLUMNS) + ", s.split FROM clientes k JOIN split s USING (ID_CORRELATIVO)", SPLIT_CTES))
def q_sink_train_test(spark, sf):
    *_, s = split_tables(spark, sf)
    path = fresh_path(spark, "splits")
    write_split_tables(clients(spark, sf), requests(spark, sf), s, path)
    return spark.read.parquet(f"{path}/clients").select(*CLIENT_COLUMNS, "split")


@register("sink_train_test_requests", with_standins(
    "SELECT r.*, s.split FROM requerimientos r JOIN split s USING (ID_CORRELATIVO)", SPLIT_CTES))
def q_sink_train_test_requests(spark, sf):
    """The request side of the split tables, read back whole."""
    *_, s = split_tables(spark, sf)
    path = fresh_path(spark, "splits")
    write_split_tables(clients(spark, sf), requests(spark, sf), s, path)
    return spark.read.parquet(f"{path}/requests").select(*requests(spark, sf).columns, "split")
