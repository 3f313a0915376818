"""Feature-order contract: with the reference's request vocabulary the local
variant (inner join + one-hot counts) yields 87 features in code-point order."""

from retenta.functions.features import ENGINEERED
from retenta.functions.schema import CLIENT_COLUMNS, DOUBLE_COLUMNS, STRING_COLUMNS
from retenta.plans.prepare import fit_prepare


def _clients(spark):
    rows = []
    for k in range(1, 7):
        row = []
        for c in CLIENT_COLUMNS:
            if c == "ID_CORRELATIVO":
                row.append(k)
            elif c == "CODMES":
                row.append(201208)
            elif c == "ATTRITION":
                row.append(k % 2)
            elif c == "RANG_INGRESO":
                row.append(f"Rang_ingreso_0{k % 3 + 1}")
            elif c == "FLAG_LIMA_PROVINCIA":
                row.append("Lima" if k % 2 else "Provincia")
            elif c == "RANG_SDO_PASIVO_MENOS0":
                row.append("Cero" if k == 1 else "Rango_SDO_01")
            elif c == "RANG_NRO_PRODUCTOS_MENOS0":
                row.append("Rango_productos_01")
            elif c in DOUBLE_COLUMNS:
                row.append(float(20 + k))
            else:
                row.append(k * 3 % 5)
        rows.append(tuple(row))
    schema = ", ".join(f"{c} {'string' if c in STRING_COLUMNS else 'double' if c in DOUBLE_COLUMNS else 'bigint'}"
                       for c in CLIENT_COLUMNS)
    return spark.createDataFrame(rows, schema)


def _requests(spark):
    # The reference's request types and verdicts.
    tipos = ["Reclamo", "Solicitud"]
    verdicts = ["NO PROCEDE", "PROCEDE PARCIAL", "PROCEDE TOTAL", None]
    rows = [(k, tipos[k % 2], verdicts[k % 4], 201208, f"p{k % 3}", f"s{k % 2}") for k in range(1, 7)]
    rows += [(k, tipos[(k + 1) % 2], verdicts[(k + 1) % 4], 201207, "p0", "s0") for k in range(1, 7)]
    return spark.createDataFrame(rows, "ID_CORRELATIVO long, TIPO_REQUERIMIENTO2 string, DICTAMEN string, "
                                       "CODMES long, PRODUCTO_SERVICIO_2 string, SUBMOTIVO_2 string")


# The 87 model inputs of the one-hot variant, in their order.
MODEL_INPUTS = [
    "ANTIGUEDAD", "EDAD", "FLAG_LIMA_PROVINCIA", "FLG_BANCARIZADO", "FLG_NOMINA", "FLG_SDO_OTSSFF_MENOS0",
    "FLG_SDO_OTSSFF_MENOS1", "FLG_SDO_OTSSFF_MENOS2", "FLG_SDO_OTSSFF_MENOS3", "FLG_SDO_OTSSFF_MENOS4",
    "FLG_SDO_OTSSFF_MENOS5", "FLG_SEGURO_MENOS0", "FLG_SEGURO_MENOS1", "FLG_SEGURO_MENOS2", "FLG_SEGURO_MENOS3",
    "FLG_SEGURO_MENOS4", "FLG_SEGURO_MENOS5", "MESES_CON_SALDO", "MESES_CON_SEGURO", "NRO_ACCES_CANAL1_MENOS0",
    "NRO_ACCES_CANAL1_MENOS1", "NRO_ACCES_CANAL1_MENOS2", "NRO_ACCES_CANAL1_MENOS3", "NRO_ACCES_CANAL1_MENOS4",
    "NRO_ACCES_CANAL1_MENOS5", "NRO_ACCES_CANAL2_MENOS0", "NRO_ACCES_CANAL2_MENOS1", "NRO_ACCES_CANAL2_MENOS2",
    "NRO_ACCES_CANAL2_MENOS3", "NRO_ACCES_CANAL2_MENOS4", "NRO_ACCES_CANAL2_MENOS5", "NRO_ACCES_CANAL3_MENOS0",
    "NRO_ACCES_CANAL3_MENOS1", "NRO_ACCES_CANAL3_MENOS2", "NRO_ACCES_CANAL3_MENOS3", "NRO_ACCES_CANAL3_MENOS4",
    "NRO_ACCES_CANAL3_MENOS5", "NRO_ENTID_SSFF_MENOS0", "NRO_ENTID_SSFF_MENOS1", "NRO_ENTID_SSFF_MENOS2",
    "NRO_ENTID_SSFF_MENOS3", "NRO_ENTID_SSFF_MENOS4", "NRO_ENTID_SSFF_MENOS5", "PROM_NRO_ACCES_CANAL1_0M_2M",
    "PROM_NRO_ACCES_CANAL1_3M_5M", "PROM_NRO_ACCES_CANAL1_6M", "PROM_NRO_ACCES_CANAL2_0M_2M",
    "PROM_NRO_ACCES_CANAL2_3M_5M", "PROM_NRO_ACCES_CANAL2_6M", "PROM_NRO_ACCES_CANAL3_0M_2M",
    "PROM_NRO_ACCES_CANAL3_3M_5M", "PROM_NRO_ACCES_CANAL3_6M", "PROM_NRO_ENTID_SSFF_0M_2M", "PROM_NRO_ENTID_SSFF_3M_5M",
    "PROM_NRO_ENTID_SSFF_6M", "PROM_SDO_ACTIVO_0M_2M", "PROM_SDO_ACTIVO_3M_5M", "PROM_SDO_ACTIVO_6M", "RANG_INGRESO",
    "RANG_NRO_PRODUCTOS_MENOS0", "RANG_SDO_PASIVO_MENOS0", "SDO_ACTIVO_MENOS0", "SDO_ACTIVO_MENOS1",
    "SDO_ACTIVO_MENOS2", "SDO_ACTIVO_MENOS3", "SDO_ACTIVO_MENOS4", "SDO_ACTIVO_MENOS5", "VAR_NRO_ACCES_CANAL1_3M",
    "VAR_NRO_ACCES_CANAL1_6M", "VAR_NRO_ACCES_CANAL2_3M", "VAR_NRO_ACCES_CANAL2_6M", "VAR_NRO_ACCES_CANAL3_3M",
    "VAR_NRO_ACCES_CANAL3_6M", "VAR_NRO_ENTID_SSFF_3M", "VAR_NRO_ENTID_SSFF_6M", "VAR_SDO_ACTIVO_3M",
    "VAR_SDO_ACTIVO_6M", "dictamen_NO PROCEDE", "dictamen_PROCEDE PARCIAL", "dictamen_PROCEDE TOTAL", "nro_dictamenes",
    "nro_productos_servicios", "nro_submotivos", "nro_tipos_requerimiento", "tipo_Reclamo", "tipo_Solicitud",
    "total_requerimientos",
]


def test_feature_order_contract(spark):
    prepared, state = fit_prepare(_clients(spark), _requests(spark), join_how="inner", with_pivot_counts=True)
    f = state.features
    assert len(f) == 87
    assert f == MODEL_INPUTS
    assert f == sorted(f)                                  # code-point order
    assert f[0] == "ANTIGUEDAD" and f[-1] == "total_requerimientos"
    assert f.index("VAR_SDO_ACTIVO_6M") + 1 == f.index("dictamen_NO PROCEDE")   # upper case before lower case
    assert {"dictamen_PROCEDE PARCIAL", "dictamen_PROCEDE TOTAL", "tipo_Reclamo", "tipo_Solicitud"} <= set(f)
    assert set(ENGINEERED) <= set(f)
    assert prepared.columns[:3] == ["ID_CORRELATIVO", "CODMES", "ATTRITION"] and prepared.columns[3:] == f
