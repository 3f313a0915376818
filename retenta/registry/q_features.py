"""Row-wise features, request aggregates and the client/request joins
(P3-P11, A1-A4, J1, J2, J4, J5) and the flagship feature table."""

from __future__ import annotations

from retenta.functions.features import ENGINEERED, FEATURE_SPEC, engineer
from retenta.functions.scalar import fill_with_value, map_values, replace_value, row_mean_skipna, row_sum_skipna
from retenta.functions.schema import CLIENT_COLUMNS, ID, STRING_COLUMNS, lag_cols
from retenta.operators.requests import DISTINCT_OUTPUTS, TOTAL, categories_dict, learn_categories, request_profile
from retenta.plans.prepare import clean_clients, clean_requests
from retenta.registry import register
from retenta.registry.common import clients, requests, rounded, sql_round
from retenta.registry.sql_standins import with_standins


# ---- SQL pieces (independent forms: DuckDB list aggregates) -------------------------------

def _sql_list(measure, lags):
    return "[" + ", ".join(f"{measure}_MENOS{i}" for i in lags) + "]"


def _sql_feature(f):
    if f.kind == "diff":
        a, b = lag_cols(f.measure, f.lags)
        return f"CAST({a} - {b} AS DOUBLE)"
    if f.kind == "mean":
        return f"list_avg({_sql_list(f.measure, f.lags)})"
    if f.kind == "mean_diff":
        a, b = f.lags
        return f"list_avg({_sql_list(f.measure, a)}) - list_avg({_sql_list(f.measure, b)})"
    if f.kind == "sum":
        return f"CAST(coalesce(list_sum({_sql_list(f.measure, f.lags)}), 0) AS DOUBLE)"
    raise ValueError(f.kind)


ENGINEERED_SQL_CTE = "eng AS (SELECT *, " + ", ".join(
    f'{_sql_feature(f)} AS "{f.name}"' for f in FEATURE_SPEC) + " FROM clientes)"

PROFILE_SQL = ("SELECT ID_CORRELATIVO, count(*) AS total_requerimientos, "
               "count(DISTINCT TIPO_REQUERIMIENTO2) AS nro_tipos_requerimiento, "
               "count(DISTINCT DICTAMEN) AS nro_dictamenes, "
               "count(DISTINCT PRODUCTO_SERVICIO_2) AS nro_productos_servicios, "
               "count(DISTINCT SUBMOTIVO_2) AS nro_submotivos "
               "FROM requerimientos WHERE ID_CORRELATIVO IS NOT NULL GROUP BY ID_CORRELATIVO")
PROFILE_COLS = [TOTAL] + [n for _, n in DISTINCT_OUTPUTS]

# Fixed values of the driver data at the checked scale: request types and verdicts.
PIVOT_SQL = ", ".join(
    [f"CAST(sum(CASE WHEN TIPO_REQUERIMIENTO2 = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS tipo_{v}" for v in "FOP"]
    + [f"CAST(sum(CASE WHEN DICTAMEN = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS dictamen_{v}" for v in "AR"])


def _eng(spark, sf):
    return engineer(clients(spark, sf))


@register("engineer_all", with_standins(
    f"SELECT ID_CORRELATIVO, {sql_round(ENGINEERED)} FROM eng", ENGINEERED_SQL_CTE))
def q_engineer_all(spark, sf):
    return rounded(_eng(spark, sf).select(ID, *ENGINEERED))


@register("diff_lag0_lag5", with_standins(
    "SELECT ID_CORRELATIVO, CAST(SDO_ACTIVO_MENOS0 - SDO_ACTIVO_MENOS5 AS DOUBLE) AS VAR_SDO_ACTIVO_6M, "
    "CAST(NRO_ENTID_SSFF_MENOS0 - NRO_ENTID_SSFF_MENOS5 AS DOUBLE) AS VAR_NRO_ENTID_SSFF_6M FROM clientes"))
def q_diff_lag0_lag5(spark, sf):
    return _eng(spark, sf).select(ID, "VAR_SDO_ACTIVO_6M", "VAR_NRO_ENTID_SSFF_6M")


@register("row_mean_skipna", with_standins(
    "SELECT ID_CORRELATIVO, " + ", ".join(
        f"round(list_avg({_sql_list('NRO_ACCES_CANAL1', lags)}), 6) AS m_{n}"
        for n, lags in (("0_2", (0, 1, 2)), ("3_5", (3, 4, 5)), ("0_5", range(6)))) + " FROM clientes"))
def q_row_mean_skipna(spark, sf):
    c = clients(spark, sf)
    return rounded(c.select(ID, *[row_mean_skipna(lag_cols("NRO_ACCES_CANAL1", lags)).alias(f"m_{n}")
                                  for n, lags in (("0_2", (0, 1, 2)), ("3_5", (3, 4, 5)), ("0_5", range(6)))]))


@register("row_sum_skipna", with_standins(
    "SELECT ID_CORRELATIVO, CAST(coalesce(list_sum(" + _sql_list("FLG_SEGURO", range(6)) + "), 0) AS BIGINT) AS s_seguro, "
    "CAST(coalesce(list_sum(" + _sql_list("NRO_ACCES_CANAL2", range(6)) + "), 0) AS BIGINT) AS s_canal2 FROM clientes"))
def q_row_sum_skipna(spark, sf):
    c = clients(spark, sf)
    return c.select(ID, row_sum_skipna(lag_cols("FLG_SEGURO")).cast("bigint").alias("s_seguro"),
                    row_sum_skipna(lag_cols("NRO_ACCES_CANAL2")).cast("bigint").alias("s_canal2"))


@register("diff_of_means", with_standins(
    f"SELECT ID_CORRELATIVO, {sql_round(['VAR_SDO_ACTIVO_3M', 'VAR_NRO_ACCES_CANAL3_3M', 'VAR_NRO_ENTID_SSFF_3M'])} "
    "FROM eng", ENGINEERED_SQL_CTE))
def q_diff_of_means(spark, sf):
    return rounded(_eng(spark, sf).select(ID, "VAR_SDO_ACTIVO_3M", "VAR_NRO_ACCES_CANAL3_3M", "VAR_NRO_ENTID_SSFF_3M"))


@register("fill_with_value", with_standins(
    "SELECT ID_CORRELATIVO, coalesce(EDAD, 42.0) AS EDAD, coalesce(RANG_INGRESO, 'MACHINERY') AS RANG_INGRESO, "
    "coalesce(SDO_ACTIVO_MENOS5, 0) AS SDO_ACTIVO_MENOS5 FROM clientes"))
def q_fill_with_value(spark, sf):
    c = clients(spark, sf)
    return c.select(ID, fill_with_value("EDAD", 42.0).alias("EDAD"),
                    fill_with_value("RANG_INGRESO", "MACHINERY").alias("RANG_INGRESO"),
                    fill_with_value("SDO_ACTIVO_MENOS5", 0).cast("bigint").alias("SDO_ACTIVO_MENOS5"))


@register("fill_zero_all", with_standins("SELECT " + ", ".join(
    c if c in STRING_COLUMNS else f"coalesce({c}, 0) AS {c}" for c in CLIENT_COLUMNS) + " FROM clientes"))
def q_fill_zero_all(spark, sf):
    c = clients(spark, sf).select(*CLIENT_COLUMNS)
    return c.na.fill(0)


@register("replace_value", with_standins(
    "SELECT ID_CORRELATIVO, CASE WHEN RANG_SDO_PASIVO_MENOS0 = 'Cero' THEN 'Rango_SDO_00' "
    "ELSE RANG_SDO_PASIVO_MENOS0 END AS RANG_SDO_PASIVO_MENOS0 FROM clientes"))
def q_replace_value(spark, sf):
    return clients(spark, sf).select(ID, replace_value("RANG_SDO_PASIVO_MENOS0", "Cero", "Rango_SDO_00")
                                     .alias("RANG_SDO_PASIVO_MENOS0"))


@register("map_binary", with_standins(
    "SELECT ID_CORRELATIVO, CAST(CASE FLAG_LIMA_PROVINCIA WHEN 'Lima' THEN 1 WHEN 'Provincia' THEN 0 END AS BIGINT) "
    "AS FLAG_LIMA_PROVINCIA FROM clientes"))
def q_map_binary(spark, sf):
    return clients(spark, sf).select(ID, map_values("FLAG_LIMA_PROVINCIA", {"Lima": 1, "Provincia": 0})
                                     .cast("bigint").alias("FLAG_LIMA_PROVINCIA"))


@register("count_requests", with_standins(
    "SELECT ID_CORRELATIVO, count(*) AS total_requerimientos FROM requerimientos "
    "WHERE ID_CORRELATIVO IS NOT NULL GROUP BY ID_CORRELATIVO"))
def q_count_requests(spark, sf):
    return request_profile(requests(spark, sf)).select(ID, TOTAL)


@register("nunique_requests", with_standins(
    "SELECT ID_CORRELATIVO, nro_tipos_requerimiento, nro_dictamenes, nro_productos_servicios, nro_submotivos "
    f"FROM ({PROFILE_SQL})"))
def q_nunique_requests(spark, sf):
    return request_profile(requests(spark, sf)).select(ID, *[n for _, n in DISTINCT_OUTPUTS])


@register("nunique_requests_expand", with_standins(
    "SELECT ID_CORRELATIVO, nro_tipos_requerimiento, nro_dictamenes, nro_productos_servicios, nro_submotivos "
    f"FROM ({PROFILE_SQL})"))
def q_nunique_requests_expand(spark, sf):
    return request_profile(requests(spark, sf), distinct="expand").select(ID, *[n for _, n in DISTINCT_OUTPUTS])


@register("request_profile", with_standins(PROFILE_SQL))
def q_request_profile(spark, sf):
    return request_profile(requests(spark, sf))


def _categories(spark, sf):
    return categories_dict(learn_categories(clean_requests(requests(spark, sf))))


@register("pivot_counts", with_standins(
    f"SELECT ID_CORRELATIVO, {PIVOT_SQL} FROM requerimientos WHERE ID_CORRELATIVO IS NOT NULL GROUP BY 1"))
def q_pivot_counts(spark, sf):
    cats = _categories(spark, sf)
    prof = request_profile(requests(spark, sf), categories=cats)
    return prof.select(ID, *[c for c in prof.columns if c.startswith(("tipo_", "dictamen_"))])


@register("concat_by_index", with_standins(
    f"SELECT p.*, {', '.join('q.' + c for c in ['tipo_F', 'tipo_O', 'tipo_P', 'dictamen_A', 'dictamen_R'])} "
    f"FROM ({PROFILE_SQL}) p JOIN (SELECT ID_CORRELATIVO, {PIVOT_SQL} FROM requerimientos "
    "WHERE ID_CORRELATIVO IS NOT NULL GROUP BY 1) q USING (ID_CORRELATIVO)"))
def q_concat_by_index(spark, sf):
    # all parts share the key set, so the column-wise concat is one aggregate
    return request_profile(requests(spark, sf), categories=_categories(spark, sf))


_J_COLS = ["EDAD", "SDO_ACTIVO_MENOS0", "NRO_ENTID_SSFF_MENOS0"]


@register("join_left_fill", with_standins(
    "SELECT k.ID_CORRELATIVO, coalesce(k.EDAD, 0) AS EDAD, coalesce(k.SDO_ACTIVO_MENOS0, 0) AS SDO_ACTIVO_MENOS0, "
    "coalesce(k.NRO_ENTID_SSFF_MENOS0, 0) AS NRO_ENTID_SSFF_MENOS0, "
    + ", ".join(f"coalesce(p.{c}, 0) AS {c}" for c in PROFILE_COLS)
    + f" FROM clientes k LEFT JOIN ({PROFILE_SQL}) p ON p.ID_CORRELATIVO = k.ID_CORRELATIVO"))
def q_join_left_fill(spark, sf):
    k = clients(spark, sf).select(ID, *_J_COLS)
    return k.join(request_profile(requests(spark, sf)), ID, "left").na.fill(0)


@register("join_inner", with_standins(
    "SELECT k.ID_CORRELATIVO, k.EDAD, k.SDO_ACTIVO_MENOS0, k.NRO_ENTID_SSFF_MENOS0, "
    + ", ".join(f"p.{c}" for c in PROFILE_COLS)
    + f" FROM clientes k JOIN ({PROFILE_SQL}) p ON p.ID_CORRELATIVO = k.ID_CORRELATIVO"))
def q_join_inner(spark, sf):
    k = clients(spark, sf).select(ID, *_J_COLS)
    return k.join(request_profile(requests(spark, sf)), ID, "inner")


@register("anti_clients_without_requests", with_standins(
    "SELECT ID_CORRELATIVO, ATTRITION FROM clientes k WHERE NOT EXISTS "
    "(SELECT 1 FROM requerimientos r WHERE r.ID_CORRELATIVO = k.ID_CORRELATIVO)"))
def q_anti_clients_without_requests(spark, sf):
    return clients(spark, sf).select(ID, "ATTRITION").join(requests(spark, sf).select(ID), ID, "left_anti")


_FLAG_COLS = ", ".join(f'"{c}"' for c in ENGINEERED)


@register("prepare_features", with_standins(
    "SELECT e.ID_CORRELATIVO, e.CODMES, e.ATTRITION, "
    + ", ".join(f'round(coalesce(e."{c}", 0), 6) AS "{c}"' for c in ENGINEERED) + ", "
    + ", ".join(f"coalesce(p.{c}, 0) AS {c}" for c in PROFILE_COLS)
    + f" FROM eng e LEFT JOIN ({PROFILE_SQL}) p ON p.ID_CORRELATIVO = e.ID_CORRELATIVO", ENGINEERED_SQL_CTE))
def q_prepare_features(spark, sf):
    """Flagship: clients with engineered features left-joined to their request profile, zero-filled."""
    return prepare_features(spark, sf)


def prepare_features(spark, sf):
    eng = engineer(clean_clients(clients(spark, sf))).select(ID, "CODMES", "ATTRITION", *ENGINEERED)
    prof = request_profile(clean_requests(requests(spark, sf)))
    return rounded(eng.join(prof, ID, "left").na.fill(0))
