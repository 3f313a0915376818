"""DuckDB SQL twin of the preparation plan (split -> impute -> engineer ->
recode -> encode -> request profile -> left join + fill 0 -> scale)."""

from __future__ import annotations

from retenta.functions.features import ENGINEERED
from retenta.functions.schema import CLIENT_COLUMNS, ID, LABEL, MONTH
from retenta.operators.requests import DISTINCT_OUTPUTS, TOTAL
from retenta.registry.q_features import ENGINEERED_SQL_CTE, PIVOT_SQL

PROFILE_COLS = [TOTAL] + [n for _, n in DISTINCT_OUTPUTS]
PIVOT_COLS = ["tipo_F", "tipo_O", "tipo_P", "dictamen_A", "dictamen_R"]
ENC_COLS = ["RANG_INGRESO", "RANG_NRO_PRODUCTOS_MENOS0", "RANG_SDO_PASIVO_MENOS0"]
KEYS = [ID, MONTH, LABEL]

SPLIT_CTES = f"""
_ids AS (SELECT DISTINCT {ID} FROM clientes),
split AS (SELECT {ID}, CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST({ID} AS VARCHAR)), {ID})
                 <= ceil(CAST(0.3 AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM _ids),
tr_c AS (SELECT * FROM clientes WHERE {ID} IN (SELECT {ID} FROM split WHERE split = 'train')),
te_c AS (SELECT * FROM clientes WHERE {ID} IN (SELECT {ID} FROM split WHERE split = 'test')),
tr_r AS (SELECT * FROM requerimientos WHERE {ID} IN (SELECT {ID} FROM split WHERE split = 'train')),
te_r AS (SELECT * FROM requerimientos WHERE {ID} IN (SELECT {ID} FROM split WHERE split = 'test'))"""


def _mode(col, table):
    return f"(SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


IMPUTATION_CTE = f"""
imp AS (SELECT {_mode('RANG_INGRESO', 'tr_c')} AS RANG_INGRESO,
               {_mode('FLAG_LIMA_PROVINCIA', 'tr_c')} AS FLAG_LIMA_PROVINCIA,
               (SELECT median(EDAD) FROM tr_c) AS EDAD,
               (SELECT median(ANTIGUEDAD) FROM tr_c) AS ANTIGUEDAD,
               {_mode('DICTAMEN', 'tr_r')} AS DICTAMEN)"""


def _eng_cte(src: str, name: str) -> str:
    return ENGINEERED_SQL_CTE.replace("eng AS (", f"{name} AS (").replace("FROM clientes)", f"FROM {src})")


def _enc_cte() -> str:
    union = " UNION ".join(f"SELECT DISTINCT '{c}' AS col, {c} AS label FROM tr_rc" for c in ENC_COLS)
    return (f"enc AS (SELECT col, label, dense_rank() OVER (PARTITION BY col ORDER BY label NULLS LAST) - 1 AS code "
            f"FROM ({union})),")


def _side(x: str, pivot: bool, join: str) -> str:
    """CTEs for split ``x`` (tr / te) up to the unscaled joined frame ``{x}_j``.
    The training side also defines the encoder ``enc``."""
    pivot_sql = f", {PIVOT_SQL}" if pivot else ""
    prof_cols = PROFILE_COLS + (PIVOT_COLS if pivot else [])
    client_cols = [c for c in CLIENT_COLUMNS] + list(ENGINEERED)
    enc_joins = " ".join(
        f"LEFT JOIN enc e{i} ON e{i}.col = '{c}' AND e{i}.label IS NOT DISTINCT FROM x.{c}"
        for i, c in enumerate(ENC_COLS))
    enc_replace = ", ".join(f"e{i}.code AS {c}" for i, c in enumerate(ENC_COLS))
    if join == "left":
        sel = ", ".join([f'coalesce(x."{c}", 0) AS "{c}"' for c in client_cols]
                        + [f"coalesce(p.{c}, 0) AS {c}" for c in prof_cols])
        jk = "LEFT JOIN"
    else:
        sel = ", ".join([f'x."{c}"' for c in client_cols] + [f"p.{c}" for c in prof_cols])
        jk = "JOIN"
    return f"""
{x}_ci AS (SELECT c.* REPLACE (coalesce(c.RANG_INGRESO, imp.RANG_INGRESO) AS RANG_INGRESO,
    coalesce(c.FLAG_LIMA_PROVINCIA, imp.FLAG_LIMA_PROVINCIA) AS FLAG_LIMA_PROVINCIA,
    coalesce(c.EDAD, imp.EDAD) AS EDAD, coalesce(c.ANTIGUEDAD, imp.ANTIGUEDAD) AS ANTIGUEDAD) FROM {x}_c c, imp),
{_eng_cte(f'{x}_ci', f'{x}_e')},
{x}_rc AS (SELECT * REPLACE (CASE WHEN RANG_SDO_PASIVO_MENOS0 = 'Cero' THEN 'Rango_SDO_00'
    ELSE RANG_SDO_PASIVO_MENOS0 END AS RANG_SDO_PASIVO_MENOS0,
    CAST(CASE FLAG_LIMA_PROVINCIA WHEN 'Lima' THEN 1 WHEN 'Provincia' THEN 0 END AS BIGINT) AS FLAG_LIMA_PROVINCIA)
    FROM {x}_e),
{_enc_cte() if x == 'tr' else ''}
{x}_ri AS (SELECT * REPLACE (coalesce(DICTAMEN, (SELECT DICTAMEN FROM imp)) AS DICTAMEN) FROM {x}_r),
{x}_p AS (SELECT {ID}, count(*) AS total_requerimientos,
    count(DISTINCT TIPO_REQUERIMIENTO2) AS nro_tipos_requerimiento, count(DISTINCT DICTAMEN) AS nro_dictamenes,
    count(DISTINCT PRODUCTO_SERVICIO_2) AS nro_productos_servicios, count(DISTINCT SUBMOTIVO_2) AS nro_submotivos
    {pivot_sql} FROM {x}_ri WHERE {ID} IS NOT NULL GROUP BY {ID}),
{x}_en AS (SELECT x.* REPLACE ({enc_replace}) FROM {x}_rc x {enc_joins}),
{x}_j AS (SELECT {sel} FROM {x}_en x {jk} {x}_p p ON p.{ID} = x.{ID})"""


def features(pivot: bool) -> list[str]:
    cols = list(CLIENT_COLUMNS) + list(ENGINEERED) + PROFILE_COLS + (PIVOT_COLS if pivot else [])
    return sorted(set(cols) - set(KEYS))


def prepare_ctes(pivot: bool = False, join: str = "left") -> str:
    feats = features(pivot)
    moments = ", ".join(f'avg("{f}") AS "m_{f}", stddev_pop("{f}") AS "s_{f}"' for f in feats)
    return (SPLIT_CTES + "," + IMPUTATION_CTE + "," + _side("tr", pivot, join) + ","
            + _side("te", pivot, join) + f",\nmom AS (SELECT {moments} FROM tr_j)")


def scaled_select(x: str, pivot: bool = False) -> str:
    feats = features(pivot)
    cols = [f"j.{k}" for k in KEYS] + [
        f'round((j."{f}" - mom."m_{f}") / CASE WHEN mom."s_{f}" = 0 THEN 1 ELSE mom."s_{f}" END, 6) AS "{f}"'
        for f in feats]
    return f"SELECT {', '.join(cols)} FROM {x}_j j, mom"
