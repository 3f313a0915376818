"""Profiling and lag layout (A10-A14, P21, P22, W9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retenta.functions.schema import CLIENT_COLUMNS, ID, LABEL, LAG_MEASURES, REQUEST_COLUMNS, STRING_COLUMNS
from retenta.operators.lags import lag_pivot, lag_unpivot, lag_variation, month_lag
from retenta.operators.profiling import (class_balance, class_weight_balanced, correlation_matrix, null_percent,
                                         profile_numeric, profile_sketch, profile_top_values)
from retenta.registry import register
from retenta.registry.common import clients, requests, rounded, scores, tables
from retenta.registry.sql_standins import with_standins

_NUM = [c for c in CLIENT_COLUMNS if c not in STRING_COLUMNS]


@register("null_percent", with_standins(
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) "
                       f"AS null_pct FROM {t}" for t, names in (("clientes", CLIENT_COLUMNS), ("requerimientos", REQUEST_COLUMNS)) for c in names)))
def q_null_percent(spark, sf):
    """Every column of both tables."""
    of = lambda df, name: null_percent(df).withColumn("table", F.lit(name))
    return rounded(of(clients(spark, sf), "clientes").unionByName(of(requests(spark, sf).select(*REQUEST_COLUMNS), "requerimientos")))


@register("class_balance", with_standins(
    "SELECT ATTRITION, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM clientes GROUP BY 1"))
def q_class_balance(spark, sf):
    return rounded(class_balance(clients(spark, sf), LABEL))


@register("class_weight_balanced", with_standins(
    "SELECT ATTRITION, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight "
    "FROM clientes GROUP BY 1"))
def q_class_weight_balanced(spark, sf):
    return rounded(class_weight_balanced(clients(spark, sf), LABEL))


@register("profile_table", with_standins(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
                       f"round(min(CAST({c} AS DOUBLE)), 6) AS min, round(max(CAST({c} AS DOUBLE)), 6) AS max, "
                       f"round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std "
                       f"FROM clientes" for c in _NUM)))
def q_profile_table(spark, sf):
    return rounded(profile_numeric(clients(spark, sf), _NUM))


@register("profile_sketch")
def q_profile_sketch(spark, sf):
    """A12 sketch part: approximate distinct counts and quartiles in bounded memory."""
    return profile_sketch(clients(spark, sf), _NUM)


_TOP = [c for c in CLIENT_COLUMNS if c != ID]


@register("profile_top_values", with_standins(
    "SELECT \"column\", value, n, rank FROM (SELECT \"column\", value, n, CAST(row_number() OVER (PARTITION BY "
    "\"column\" ORDER BY n DESC, value) AS BIGINT) AS rank FROM (SELECT \"column\", value, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM clientes" for c in _TOP)
    + ") WHERE value IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 5"))
def q_profile_top_values(spark, sf):
    """A12 top values: five most frequent values per column."""
    return profile_top_values(clients(spark, sf), _TOP, 5)


_CORR = [*_NUM, "y_prob"]


@register("correlation_matrix", with_standins(
    "SELECT a, b, CASE WHEN isfinite(r) THEN round(r, 6) + 0.0 END AS corr FROM (SELECT unnest(["
    + ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))}}"
                for i, a in enumerate(_CORR) for b in _CORR[i + 1:])
    + "], recursive := true) FROM (SELECT c.*, s.y_prob FROM clientes c JOIN scores s USING (ID_CORRELATIVO)))"))
def q_correlation_matrix(spark, sf):
    """A14: every pair of the numeric client columns and the score."""
    k = clients(spark, sf).join(scores(spark, sf).select(ID, "y_prob"), ID)
    return rounded(correlation_matrix(k, _CORR))


@register("month_lag_pivot", """
SELECT o_custkey AS ID_CORRELATIVO, """ + ", ".join(
    f"CAST(sum(CASE WHEN lag = {i} THEN cents END) AS BIGINT) AS SDO_MENSUAL_MENOS{i}" for i in range(6)) + """
FROM (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
             24013 - (year(o_orderdate) * 12 + month(o_orderdate) - 1) AS lag FROM orders)
WHERE lag BETWEEN 0 AND 5 GROUP BY o_custkey""")
def q_month_lag_pivot(spark, sf):
    o = tables(spark, sf).orders.select(
        F.col("o_custkey").alias(ID), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        month_lag("o_orderdate", 200102).alias("lag"))
    return lag_pivot(o, ID, "lag", "cents", "SDO_MENSUAL")


_UNPIVOT_SQL = ("wide AS (SELECT ID_CORRELATIVO, " + ", ".join(
    f"CAST({m}_MENOS{i} AS DOUBLE) AS {m}_MENOS{i}" for m in LAG_MEASURES for i in range(6)) + " FROM clientes), "
    "long AS (SELECT ID_CORRELATIVO, regexp_extract(variable, '^(.*)_MENOS([0-9]+)$', 1) AS measure, "
    "CAST(regexp_extract(variable, '^(.*)_MENOS([0-9]+)$', 2) AS INTEGER) AS lag, value FROM "
    "wide UNPIVOT INCLUDE NULLS (value FOR variable IN (" + ", ".join(
        f"{m}_MENOS{i}" for m in LAG_MEASURES for i in range(6)) + ")))")


@register("lag_unpivot", with_standins("SELECT * FROM long", _UNPIVOT_SQL))
def q_lag_unpivot(spark, sf):
    return lag_unpivot(clients(spark, sf), LAG_MEASURES)


@register("lag_based_variation", with_standins(
    "SELECT ID_CORRELATIVO, measure, lag, value, value - lag(value) OVER w AS mom_change, "
    "round(avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS avg_3m FROM long "
    "WINDOW w AS (PARTITION BY ID_CORRELATIVO, measure ORDER BY lag DESC)", _UNPIVOT_SQL))
def q_lag_based_variation(spark, sf):
    return rounded(lag_variation(lag_unpivot(clients(spark, sf), LAG_MEASURES)))
