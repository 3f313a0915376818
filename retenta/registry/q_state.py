"""Fitted state: imputation, encoding, scaling, feature order, and the full
fit-on-train / apply-on-test preparation (A5-A9, P12-P16, F5, IO6-IO8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retenta.functions.schema import CLIENT_COLUMNS, ID, LABEL, MONTH, STRING_COLUMNS
from retenta.operators.encoding import apply_label_encoder, fit_label_encoder, recode
from retenta.operators.imputation import fit_imputation, fit_table
from retenta.operators.scaling import NOT_SCALED, apply_standardizer, fit_standardizer
from retenta.plans.prepare import STATE_TABLES, PreparedState, apply_prepare, clean_clients, clean_requests, fit_prepare
from retenta.registry import register
from retenta.registry.common import clients, requests, rounded, split_tables
from retenta.registry.sql_prepare import ENC_COLS, IMPUTATION_CTE, SPLIT_CTES, features, prepare_ctes, scaled_select
from retenta.registry.sql_standins import with_standins
from retenta.session import fresh_path
from retenta.sources.io import read_state, write_state


def _mode_sql(col, table):
    return (f"SELECT '{col}' AS variable, {col} AS value FROM (SELECT {col}, count(*) AS n FROM {table} "
            f"WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1)")


@register("fit_mode", with_standins(
    "(" + _mode_sql("RANG_INGRESO", "clientes") + ") UNION ALL (" + _mode_sql("FLAG_LIMA_PROVINCIA", "clientes")
    + ") UNION ALL (" + _mode_sql("DICTAMEN", "requerimientos") + ")"))
def q_fit_mode(spark, sf):
    c = fit_table(clients(spark, sf), "clientes", (("RANG_INGRESO", "moda"), ("FLAG_LIMA_PROVINCIA", "moda")))
    r = fit_table(requests(spark, sf), "requerimientos", (("DICTAMEN", "moda"),))
    return c.unionByName(r).select("variable", "value")


@register("fit_median", with_standins(
    "SELECT median(EDAD) AS EDAD, median(ANTIGUEDAD) AS ANTIGUEDAD, "
    "median(CAST(SDO_ACTIVO_MENOS0 AS DOUBLE)) AS SDO_ACTIVO_MENOS0 FROM clientes"))
def q_fit_median(spark, sf):
    c = clients(spark, sf)
    return c.agg(F.median("EDAD").alias("EDAD"), F.median("ANTIGUEDAD").alias("ANTIGUEDAD"),
                 F.median(F.col("SDO_ACTIVO_MENOS0").cast("double")).alias("SDO_ACTIVO_MENOS0"))


@register("fit_imputation", with_standins(
    "SELECT * FROM (VALUES ('clientes', 'RANG_INGRESO', 'moda'), ('clientes', 'FLAG_LIMA_PROVINCIA', 'moda'), "
    "('clientes', 'EDAD', 'mediana'), ('clientes', 'ANTIGUEDAD', 'mediana'), ('requerimientos', 'DICTAMEN', 'moda')) "
    "v(dataframe, variable, strategy) JOIN (UNPIVOT (SELECT RANG_INGRESO, FLAG_LIMA_PROVINCIA, "
    "CAST(EDAD AS VARCHAR) AS EDAD, CAST(ANTIGUEDAD AS VARCHAR) AS ANTIGUEDAD, DICTAMEN FROM imp) "
    "ON COLUMNS(*) INTO NAME variable VALUE value) u USING (variable)", SPLIT_CTES + "," + IMPUTATION_CTE))
def q_fit_imputation(spark, sf):
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    return fit_imputation(clean_clients(tr_c), clean_requests(tr_r))


@register("filter_param_lookup", with_standins(
    "SELECT 'EDAD' AS variable, CAST(EDAD AS VARCHAR) AS value FROM imp", SPLIT_CTES + "," + IMPUTATION_CTE))
def q_filter_param_lookup(spark, sf):
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    return fit_imputation(tr_c, tr_r).where(F.col("variable") == "EDAD").select("variable", "value")


def _recoded(spark, sf):
    return recode(clean_clients(clients(spark, sf)))


ENC_SQL = ("SELECT col AS \"column\", label, CAST(dense_rank() OVER (PARTITION BY col ORDER BY label NULLS LAST) - 1 "
           "AS BIGINT) AS code FROM (" + " UNION ".join(
               f"SELECT DISTINCT '{c}' AS col, {c} AS label FROM (SELECT CASE WHEN RANG_SDO_PASIVO_MENOS0 = 'Cero' "
               f"THEN 'Rango_SDO_00' ELSE RANG_SDO_PASIVO_MENOS0 END AS RANG_SDO_PASIVO_MENOS0, RANG_INGRESO, "
               f"RANG_NRO_PRODUCTOS_MENOS0 FROM clientes)" for c in ENC_COLS) + ")")


@register("fit_label_encoder", with_standins(ENC_SQL))
def q_fit_label_encoder(spark, sf):
    return fit_label_encoder(_recoded(spark, sf), ENC_COLS)


@register("label_encode_apply", with_standins(
    "SELECT k.ID_CORRELATIVO, " + ", ".join(f"e{i}.code AS {c}" for i, c in enumerate(ENC_COLS))
    + " FROM (SELECT ID_CORRELATIVO, RANG_INGRESO, RANG_NRO_PRODUCTOS_MENOS0, CASE WHEN RANG_SDO_PASIVO_MENOS0 = "
    "'Cero' THEN 'Rango_SDO_00' ELSE RANG_SDO_PASIVO_MENOS0 END AS RANG_SDO_PASIVO_MENOS0 FROM clientes) k "
    + " ".join(f"LEFT JOIN enc e{i} ON e{i}.\"column\" = '{c}' AND e{i}.label IS NOT DISTINCT FROM k.{c}"
               for i, c in enumerate(ENC_COLS)), f"enc AS ({ENC_SQL})"))
def q_label_encode_apply(spark, sf):
    r = _recoded(spark, sf)
    enc = fit_label_encoder(r, ENC_COLS)
    return apply_label_encoder(r.select(ID, *ENC_COLS), enc, ENC_COLS, on_unseen="error")


# every number of the clients, and the month as a constant (no deviation)
_SCALE_COLS = [c for c in CLIENT_COLUMNS if c not in STRING_COLUMNS and c not in NOT_SCALED] + ["CODMES_COPY"]
_SCALE_SRC = ("SELECT ID_CORRELATIVO, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _SCALE_COLS[:-1])
              + ", CODMES AS CODMES_COPY FROM clientes")


def _scale_src(spark, sf):
    c = clients(spark, sf)
    return c.select(ID, *_SCALE_COLS[:-1], F.col(MONTH).alias("CODMES_COPY")).na.fill(0)


@register("fit_standardizer", with_standins(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std "
                       f"FROM src" for c in _SCALE_COLS), f"src AS ({_SCALE_SRC})"))
def q_fit_standardizer(spark, sf):
    return rounded(fit_standardizer(_scale_src(spark, sf), _SCALE_COLS))


@register("standardize_apply", with_standins(
    "SELECT ID_CORRELATIVO, " + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM src)) / CASE WHEN (SELECT stddev_pop({c}) FROM src) = 0 THEN 1 "
        f"ELSE (SELECT stddev_pop({c}) FROM src) END, 6) AS {c}" for c in _SCALE_COLS) + " FROM src",
    f"src AS ({_SCALE_SRC})"))
def q_standardize_apply(spark, sf):
    src = _scale_src(spark, sf)
    return rounded(apply_standardizer(src, fit_standardizer(src, _SCALE_COLS), _SCALE_COLS, keep=(ID,)))


@register("prepare_train", with_standins(scaled_select("tr"), prepare_ctes()))
def q_prepare_train(spark, sf):
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    prepared, _ = fit_prepare(tr_c, tr_r)
    return rounded(prepared)


@register("prepare_test", with_standins(scaled_select("te"), prepare_ctes()))
def q_prepare_test(spark, sf):
    tr_c, te_c, tr_r, te_r, _ = split_tables(spark, sf)
    _, state = fit_prepare(tr_c, tr_r)
    return rounded(apply_prepare(te_c, te_r, state))


@register("prepare_train_inner_pivot", with_standins(scaled_select("tr", True), prepare_ctes(True, "inner")))
def q_prepare_train_inner_pivot(spark, sf):
    """Local tracked pipeline: inner join and one-hot request counts."""
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    prepared, _ = fit_prepare(tr_c, tr_r, join_how="inner", with_pivot_counts=True)
    return rounded(prepared)


@register("select_features", with_standins(
    "SELECT " + ", ".join(f'"{f}"' for f in features(False)) + f" FROM ({scaled_select('te')})", prepare_ctes()))
def q_select_features(spark, sf):
    tr_c, te_c, tr_r, te_r, _ = split_tables(spark, sf)
    _, state = fit_prepare(tr_c, tr_r)
    return rounded(apply_prepare(te_c, te_r, state).select(*[F.col(f"`{f}`") for f in state.features]))


@register("sorted_feature_columns",
          "SELECT CAST(row_number() OVER (ORDER BY column_name) - 1 AS INTEGER) AS pos, column_name AS name FROM "
          "(DESCRIBE " + with_standins(scaled_select("tr", True), prepare_ctes(True, "inner")) + ") "
          "WHERE column_name NOT IN ('ID_CORRELATIVO', 'CODMES', 'ATTRITION')")
def q_sorted_feature_columns(spark, sf):
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    _, state = fit_prepare(tr_c, tr_r, join_how="inner", with_pivot_counts=True)
    return state.feature_table(spark)


@register("exclude_non_features", with_standins(
    "SELECT " + ", ".join(f'"{f}"' for f in features(False)) + f" FROM ({scaled_select('tr')})", prepare_ctes()))
def q_exclude_non_features(spark, sf):
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    prepared, _ = fit_prepare(tr_c, tr_r)
    return rounded(prepared.drop(ID, MONTH, LABEL))


@register("sink_fitted_state", with_standins(f"""
SELECT 'imputation' AS "table", CAST(5 AS BIGINT) AS "rows"
UNION ALL SELECT 'encoding', (SELECT count(*) FROM enc)
UNION ALL SELECT 'moments', CAST({len(features(False))} AS BIGINT)
UNION ALL SELECT 'features', CAST({len(features(False))} AS BIGINT)
UNION ALL SELECT 'settings', CAST(2 AS BIGINT)
UNION ALL SELECT 'categories', CAST(0 AS BIGINT)""", prepare_ctes()))
def q_sink_fitted_state(spark, sf):
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    _, state = fit_prepare(tr_c, tr_r)
    path = fresh_path(spark, "state")
    write_state(state.tables(spark), path)
    back = read_state(spark, path, STATE_TABLES)
    counts = [df.groupBy().agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
              for name, df in back.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("load_fitted_state", with_standins(scaled_select("te"), prepare_ctes()))
def q_load_fitted_state(spark, sf):
    """Fit on train, persist the state tables, read them back and apply to test."""
    tr_c, te_c, tr_r, te_r, _ = split_tables(spark, sf)
    _, state = fit_prepare(tr_c, tr_r)
    path = fresh_path(spark, "state_load")
    write_state(state.tables(spark), path)
    state = PreparedState.from_tables(read_state(spark, path, STATE_TABLES))
    return rounded(apply_prepare(te_c, te_r, state))


@register("sink_prepared", with_standins(scaled_select("tr"), prepare_ctes()))
def q_sink_prepared(spark, sf):
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    prepared, _ = fit_prepare(tr_c, tr_r)
    path = fresh_path(spark, "prepared")
    rounded(prepared).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

