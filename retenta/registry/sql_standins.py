"""DuckDB SQL for the stand-in client snapshot and request log, used as a
WITH prefix by every oracle query. Written independently of the Spark code
(lag membership as index ranges, distinct suppliers via count(DISTINCT))."""

from __future__ import annotations

from retenta.sources.standins import ANCHOR_MONTH, month_key

A = month_key(ANCHOR_MONTH)


def _lag_range(i: int) -> str:
    return f"idx BETWEEN {12 * i} AND {12 * i + 11}"


def _client_select() -> str:
    sdo = ",\n".join(f"CAST(sum(CASE WHEN {_lag_range(i)} THEN cents END) // 100 AS BIGINT) AS SDO_ACTIVO_MENOS{i}"
                     for i in range(6))
    seg = ",\n".join(f"CAST(max(CASE WHEN {_lag_range(i)} AND o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) "
                     f"AS FLG_SEGURO_MENOS{i}" for i in range(6))
    ent = ",\n".join(f"nullif(count(DISTINCT CASE WHEN {_lag_range(i)} THEN l_suppkey END), 0) AS NRO_ENTID_SSFF_MENOS{i}"
                     for i in range(6))
    ret = ",\n".join(f"CAST(max(CASE WHEN {_lag_range(i)} THEN (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) END) "
                     f"AS BIGINT) AS FLG_SDO_OTSSFF_MENOS{i}" for i in range(6))
    ev = ",\n".join(
        f"nullif(count(CASE WHEN day_no BETWEEN {5 * (5 - i)} AND {5 * (5 - i) + 4} AND event_type = '{t}' THEN 1 END), 0)"
        f" AS NRO_ACCES_CANAL{k}_MENOS{i}"
        for k, t in ((1, "click"), (2, "view"), (3, "purchase")) for i in range(6))
    cols = ["c.c_custkey AS ID_CORRELATIVO", f"CAST({ANCHOR_MONTH} AS BIGINT) AS CODMES",
            "CAST(c.c_custkey % 2 AS BIGINT) AS FLG_BANCARIZADO",
            "CASE WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_mktsegment END AS RANG_INGRESO",
            "CASE WHEN r.r_name IN ('AMERICA', 'ASIA') THEN 'Lima' WHEN r.r_name <> 'AFRICA' THEN 'Provincia' END "
            "AS FLAG_LIMA_PROVINCIA",
            "CASE WHEN c.c_custkey % 11 <> 0 THEN CAST(18 + c.c_custkey % 60 AS DOUBLE) END AS EDAD",
            "CAST(om.first_idx // 12 AS DOUBLE) AS ANTIGUEDAD",
            "CAST(CASE WHEN om.active_after = 1 THEN 0 ELSE 1 END AS BIGINT) AS ATTRITION",
            "CASE WHEN c.c_acctbal < 0 THEN 'Cero' ELSE 'Rango_SDO_0' || "
            "CAST(1 + CAST(floor(c.c_acctbal / 2500) AS BIGINT) AS VARCHAR) END AS RANG_SDO_PASIVO_MENOS0"]
    cols += [f"om.SDO_ACTIVO_MENOS{i}" for i in range(6)]
    cols += [f"coalesce(om.FLG_SEGURO_MENOS{i}, 0) AS FLG_SEGURO_MENOS{i}" for i in range(6)]
    cols += ["'Rango_productos_0' || CAST(1 + c.c_custkey % 4 AS VARCHAR) AS RANG_NRO_PRODUCTOS_MENOS0",
             "CAST(CASE WHEN c.c_custkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLG_NOMINA"]
    cols += [f"em.NRO_ACCES_CANAL{k}_MENOS{i}" for k in (1, 2, 3) for i in range(6)]
    cols += [f"im.NRO_ENTID_SSFF_MENOS{i}" for i in range(6)]
    cols += [f"coalesce(im.FLG_SDO_OTSSFF_MENOS{i}, 0) AS FLG_SDO_OTSSFF_MENOS{i}" for i in range(6)]
    col_text = ",\n  ".join(cols)
    return f"""
_ord AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         {A} - (year(o_orderdate) * 12 + month(o_orderdate) - 1) AS idx
  FROM orders),
_om AS (
  SELECT o_custkey AS ID_CORRELATIVO,
  {sdo},
  {seg},
  max(CASE WHEN idx >= 0 THEN idx END) AS first_idx,
  max(CASE WHEN o_orderdate >= TIMESTAMP '2001-03-01' THEN 1 ELSE 0 END) AS active_after
  FROM _ord GROUP BY o_custkey),
_im AS (
  SELECT o.o_custkey AS ID_CORRELATIVO,
  {ent},
  {ret}
  FROM _ord o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  WHERE o.idx BETWEEN 0 AND 71
  GROUP BY o.o_custkey),
_ev AS (
  SELECT user_id, event_type, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day_no
  FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'),
_em AS (
  SELECT user_id AS ID_CORRELATIVO,
  {ev}
  FROM _ev GROUP BY user_id),
clientes AS (
  SELECT {col_text}
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN _om om ON om.ID_CORRELATIVO = c.c_custkey
  LEFT JOIN _im im ON im.ID_CORRELATIVO = c.c_custkey
  LEFT JOIN _em em ON em.ID_CORRELATIVO = c.c_custkey),
requerimientos AS (
  SELECT o_custkey AS ID_CORRELATIVO, o_orderstatus AS TIPO_REQUERIMIENTO2,
         nullif(l_returnflag, 'N') AS DICTAMEN,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS CODMES,
         p_type AS PRODUCTO_SERVICIO_2, o_orderpriority AS SUBMOTIVO_2
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  WHERE year(o_orderdate) * 100 + month(o_orderdate) BETWEEN 200009 AND 200102),
scores AS (
  SELECT k.ID_CORRELATIVO, k.ATTRITION,
         ((CAST(round(cu.c_acctbal * 100) AS BIGINT) + 100000) // 11000) / CAST(100 AS DOUBLE) AS y_prob
  FROM clientes k JOIN customer cu ON cu.c_custkey = k.ID_CORRELATIVO)"""


STANDIN_CTES = _client_select()


def with_standins(body: str, ctes: str = "") -> str:
    """Prefix ``body`` with the stand-in CTEs (and extra CTEs ``ctes``)."""
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {STANDIN_CTES}{extra}\n{body}"
