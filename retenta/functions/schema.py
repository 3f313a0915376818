"""Column names of the client snapshot and the request log.

Fixed values that must equal the reference's table contract: the lag
measures, the categorical columns and the order of the 53 snapshot columns.
"""

from __future__ import annotations

ID = "ID_CORRELATIVO"
MONTH = "CODMES"
LABEL = "ATTRITION"
N_LAGS = 6

# Lag measures of the client snapshot (suffix _MENOS0.._MENOS5).
LAG_MEASURES = ("SDO_ACTIVO", "FLG_SEGURO", "NRO_ACCES_CANAL1", "NRO_ACCES_CANAL2",
                "NRO_ACCES_CANAL3", "NRO_ENTID_SSFF", "FLG_SDO_OTSSFF")

# Order of the typed client projection.
_HEAD = ["ID_CORRELATIVO", "CODMES", "FLG_BANCARIZADO", "RANG_INGRESO", "FLAG_LIMA_PROVINCIA",
         "EDAD", "ANTIGUEDAD", "ATTRITION", "RANG_SDO_PASIVO_MENOS0"]


def lag_cols(measure: str, lags=range(N_LAGS)) -> list[str]:
    return [f"{measure}_MENOS{i}" for i in lags]


CLIENT_COLUMNS = (_HEAD + lag_cols("SDO_ACTIVO") + lag_cols("FLG_SEGURO")
                  + ["RANG_NRO_PRODUCTOS_MENOS0", "FLG_NOMINA"]
                  + lag_cols("NRO_ACCES_CANAL1") + lag_cols("NRO_ACCES_CANAL2")
                  + lag_cols("NRO_ACCES_CANAL3") + lag_cols("NRO_ENTID_SSFF")
                  + lag_cols("FLG_SDO_OTSSFF"))

STRING_COLUMNS = ("RANG_INGRESO", "FLAG_LIMA_PROVINCIA", "RANG_SDO_PASIVO_MENOS0",
                  "RANG_NRO_PRODUCTOS_MENOS0")
DOUBLE_COLUMNS = ("EDAD", "ANTIGUEDAD")
BIGINT_COLUMNS = tuple(c for c in CLIENT_COLUMNS
                       if c not in STRING_COLUMNS and c not in DOUBLE_COLUMNS)

# Request log columns.
REQ_TYPE = "TIPO_REQUERIMIENTO2"
REQ_VERDICT = "DICTAMEN"
REQ_PRODUCT = "PRODUCTO_SERVICIO_2"
REQ_REASON = "SUBMOTIVO_2"
REQUEST_COLUMNS = (ID, REQ_TYPE, REQ_VERDICT, MONTH, REQ_PRODUCT, REQ_REASON)

# The three text columns where '' means missing.
EMPTY_AS_NULL_CLIENT = ("RANG_INGRESO", "FLAG_LIMA_PROVINCIA")
EMPTY_AS_NULL_REQUEST = ("DICTAMEN",)
