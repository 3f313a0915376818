"""Sources, sinks-as-reads, filters and safe casts (IO1-IO4, IO12, F1, F2, P1, P2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retenta.functions.scalar import empty_to_null, rename_upper, try_cast_numeric, typed_projection
from retenta.functions.schema import BIGINT_COLUMNS, CLIENT_COLUMNS, DOUBLE_COLUMNS, ID, MONTH, STRING_COLUMNS
from retenta.registry import register
from retenta.registry.common import clients, requests
from retenta.registry.sql_standins import with_standins
from retenta.sources import events as ev
from retenta.sources.io import read_clients_csv, save_by_month, table_joined_months, table_months, write_clients_csv
from retenta.session import fresh_path

ALL_COLS = ", ".join(CLIENT_COLUMNS)


@register("clients_snapshot", with_standins(f"SELECT {ALL_COLS} FROM clientes"))
def q_clients_snapshot(spark, sf):
    return clients(spark, sf)


@register("requests_log", with_standins("SELECT * FROM requerimientos"))
def q_requests_log(spark, sf):
    return requests(spark, sf)


@register("scan_requests_range", with_standins(
    "SELECT * FROM requerimientos WHERE CODMES BETWEEN 200011 AND 200101"))
def q_scan_requests_range(spark, sf):
    # the month range is pushed to the orders scan as a date range
    return requests(spark, sf, (200011, 200101))


@register("filter_month_between", with_standins(
    "SELECT * FROM requerimientos WHERE CODMES BETWEEN 200010 AND 200012"))
def q_filter_month_between(spark, sf):
    return requests(spark, sf).where(F.col(MONTH).between(200010, 200012))


@register("filter_month_eq_clients", with_standins(f"SELECT {ALL_COLS} FROM clientes"))
def q_filter_month_eq_clients(spark, sf):
    """Snapshots of two months in one table, filtered to one month: the filter on the
    month literal removes the other month's whole branch from the plan."""
    from retenta.sources.standins import clients as build
    from retenta.registry.common import tables
    t = tables(spark, sf)
    both = build(t, 200101).unionByName(build(t, 200102))
    return both.where(F.col(MONTH) == F.lit(200102))


@register("filter_month_eq", with_standins(
    "SELECT * FROM requerimientos WHERE CAST(CODMES AS VARCHAR) = '200012'"))
def q_filter_month_eq(spark, sf):
    # the reference compares the month as text with a quoted literal
    return requests(spark, sf).where(F.col(MONTH).cast("string") == F.lit("200012"))


def _saved_requests(spark, sf):
    """The request log as a catalog table partitioned by month."""
    import uuid
    name = f"retenta_requests_{uuid.uuid4().hex}"
    save_by_month(requests(spark, sf), name, fresh_path(spark, "catalog-requests"))
    return name


@register("catalog_scan_months", with_standins("SELECT * FROM requerimientos WHERE CODMES BETWEEN 200011 AND 200101"))
def q_catalog_scan_months(spark, sf):
    """A month range of a stored table partitioned by month, by bound parameters."""
    return table_months(spark, _saved_requests(spark, sf), 200011, 200101).select(*requests(spark, sf).columns)


@register("catalog_scan_joined_months", with_standins(
    "SELECT * FROM requerimientos WHERE CODMES IN (SELECT CODMES FROM requerimientos GROUP BY CODMES HAVING CODMES % 2 = 0)"))
def q_catalog_scan_joined_months(spark, sf):
    """The months to read stand in a table: dynamic partition pruning of the stored request log."""
    wanted = requests(spark, sf).select(MONTH).distinct().where(F.col(MONTH) % 2 == 0)
    return table_joined_months(spark, _saved_requests(spark, sf), wanted).select(*requests(spark, sf).columns)


@register("catalog_scan_client_month", with_standins(f"SELECT {ALL_COLS} FROM clientes"))
def q_catalog_scan_client_month(spark, sf):
    """Snapshots of three months stored by month; one month read, with its safe-cast projection."""
    import uuid
    from retenta.sources.standins import clients as build
    from retenta.registry.common import tables
    t, name = tables(spark, sf), f"retenta_clients_{uuid.uuid4().hex}"
    months = build(t, 200012).unionByName(build(t, 200101)).unionByName(build(t, 200102))
    save_by_month(months, name, fresh_path(spark, "catalog-clients"))
    return table_months(spark, name, 200102, 200102).select(*CLIENT_COLUMNS)


# Raw text columns with junk: '' every 7th key, 'x'-suffixed every 13th,
# a decimal every 17th; the rest is the integer text.
def _text(c: str, k: str = ID):
    key = F.col(k)
    return (F.when(key % 7 == 0, F.lit(""))
            .when(key % 13 == 0, F.concat(F.col(c).cast("string"), F.lit("x")))
            .when(key % 17 == 0, F.concat(F.col(c).cast("bigint").cast("string"), F.lit(".5")))
            .otherwise(F.col(c).cast("bigint").cast("string")))


_TEXT_SQL = ("CASE WHEN {k} % 7 = 0 THEN '' WHEN {k} % 13 = 0 THEN CAST({c} AS VARCHAR) || 'x' "
             "WHEN {k} % 17 = 0 THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) || '.5' "
             "ELSE CAST(CAST({c} AS BIGINT) AS VARCHAR) END")
# DuckDB TRY_CAST('1.5' AS BIGINT) rounds to 2; Spark gives null, so the
# oracle guards with an integer pattern
_TRY_BIGINT_SQL = "CASE WHEN regexp_full_match(trim({v}), '[+-]?[0-9]+') THEN TRY_CAST(trim({v}) AS BIGINT) END"


def _raw_text_clients(spark, sf):
    c = clients(spark, sf)
    cols = []
    for name in CLIENT_COLUMNS:
        if name in STRING_COLUMNS:
            cols.append(F.col(name))
        elif name == ID:
            cols.append(F.col(ID).cast("string").alias(ID))
        elif name == MONTH:
            cols.append(F.col(MONTH).cast("string").alias(MONTH))
        else:
            cols.append(_text(name).alias(name))
    return c.select(*cols)


def _raw_text_sql_cte():
    cols = []
    for name in CLIENT_COLUMNS:
        if name in STRING_COLUMNS:
            cols.append(name)
        elif name in (ID, MONTH):
            cols.append(f"CAST({name} AS VARCHAR) AS {name}")
        else:
            cols.append(_TEXT_SQL.format(k=ID, c=name) + f" AS {name}")
    return "raw_text AS (SELECT " + ", ".join(cols) + " FROM clientes)"


def _typed_sql():
    cols = []
    for name in CLIENT_COLUMNS:
        if name in STRING_COLUMNS:
            cols.append(name)
        elif name in DOUBLE_COLUMNS:
            cols.append(f"TRY_CAST({name} AS DOUBLE) AS {name}")
        else:
            cols.append(_TRY_BIGINT_SQL.format(v=name) + f" AS {name}")
    return "SELECT " + ", ".join(cols) + " FROM raw_text"


@register("scan_typed_projection", with_standins(_typed_sql(), _raw_text_sql_cte()))
def q_scan_typed_projection(spark, sf):
    raw = _raw_text_clients(spark, sf)
    return typed_projection(raw, BIGINT_COLUMNS, DOUBLE_COLUMNS, keep=STRING_COLUMNS, order=CLIENT_COLUMNS)


@register("try_cast_numeric", with_standins(
    "SELECT ID_CORRELATIVO, " + _TRY_BIGINT_SQL.format(v="t") + " AS as_bigint, "
    "TRY_CAST(CASE WHEN t = '' THEN NULL ELSE t END AS DOUBLE) AS as_double FROM "
    "(SELECT ID_CORRELATIVO, " + _TEXT_SQL.format(k="ID_CORRELATIVO", c="SDO_ACTIVO_MENOS0") + " AS t FROM clientes)"))
def q_try_cast_numeric(spark, sf):
    t = clients(spark, sf).select(ID, _text("SDO_ACTIVO_MENOS0").alias("t"))
    return t.select(ID, try_cast_numeric("t", "bigint").alias("as_bigint"),
                    try_cast_numeric(empty_to_null("t"), "double").alias("as_double"))


@register("empty_to_null", with_standins(
    "SELECT ID_CORRELATIVO, nullif(CASE WHEN ID_CORRELATIVO % 7 = 0 THEN '' ELSE RANG_INGRESO END, '') AS RANG_INGRESO, "
    "nullif(CASE WHEN ID_CORRELATIVO % 5 = 0 THEN '' ELSE DICTAMEN END, '') AS DICTAMEN "
    "FROM (SELECT k.ID_CORRELATIVO, k.RANG_INGRESO, r.DICTAMEN FROM clientes k "
    "JOIN (SELECT ID_CORRELATIVO, min(DICTAMEN) AS DICTAMEN FROM requerimientos GROUP BY 1) r USING (ID_CORRELATIVO))"))
def q_empty_to_null(spark, sf):
    r = requests(spark, sf).groupBy(ID).agg(F.min("DICTAMEN").alias("DICTAMEN"))
    k = clients(spark, sf).select(ID, "RANG_INGRESO").join(r, ID)
    src = k.select(ID, F.when(F.col(ID) % 7 == 0, F.lit("")).otherwise(F.col("RANG_INGRESO")).alias("RANG_INGRESO"),
                   F.when(F.col(ID) % 5 == 0, F.lit("")).otherwise(F.col("DICTAMEN")).alias("DICTAMEN"))
    return src.select(ID, empty_to_null("RANG_INGRESO").alias("RANG_INGRESO"),
                      empty_to_null("DICTAMEN").alias("DICTAMEN"))


@register("rename_upper", with_standins(
    f"SELECT {ALL_COLS} FROM clientes"))
def q_rename_upper(spark, sf):
    lower = clients(spark, sf).select(*[F.col(c).alias(c.lower()) for c in CLIENT_COLUMNS])
    return rename_upper(lower)


@register("scan_csv_clients", with_standins(f"SELECT {ALL_COLS} FROM clientes"))
def q_scan_csv_clients(spark, sf):
    path = fresh_path(spark, "csv_clients")
    write_clients_csv(clients(spark, sf), path)
    return read_clients_csv(spark, path)


_EVENT_SQL = """
SELECT r.ID_CORRELATIVO, r.TIPO_REQUERIMIENTO2, r.DICTAMEN, r.CODMES, r.PRODUCTO_SERVICIO_2, r.SUBMOTIVO_2
FROM clientes k JOIN requerimientos r ON r.ID_CORRELATIVO = k.ID_CORRELATIVO
"""


@register("read_event_json", with_standins(_EVENT_SQL))
def q_read_event_json(spark, sf):
    # every client/request pair becomes one online event (JSON text), parsed back
    text = ev.to_event_json(clients(spark, sf), requests(spark, sf))
    _, parsed_reqs = ev.parse_events(text)
    return parsed_reqs
