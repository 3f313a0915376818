"""Hand-written edge rows (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from retenta.functions.features import engineer
from retenta.functions.scalar import risk_band, row_mean_skipna, row_sum_skipna
from retenta.functions.schema import CLIENT_COLUMNS, lag_cols
from retenta.operators.encoding import apply_label_encoder, fit_label_encoder
from retenta.operators.evaluation import roc_auc, roc_curve, youden_threshold, precision_recall_f1
from retenta.operators.imputation import fit_table
from retenta.operators.requests import request_profile
from retenta.operators.scaling import apply_standardizer, fit_standardizer
from retenta.operators.publish import rank_desc


def _lags(spark, rows):
    cols = ", ".join(f"{c} bigint" for c in lag_cols("SDO_ACTIVO"))
    return spark.createDataFrame(rows, f"id bigint, {cols}")


def test_all_lags_null_and_only_lag5_null(spark):
    df = _lags(spark, [(1, None, None, None, None, None, None), (2, 6, 3, 3, 1, 2, None)])
    out = {r["id"]: r for r in df.select("id",
           row_mean_skipna(lag_cols("SDO_ACTIVO")).alias("m"),
           row_sum_skipna(lag_cols("SDO_ACTIVO")).alias("s"),
           (F.col("SDO_ACTIVO_MENOS0") - F.col("SDO_ACTIVO_MENOS5")).alias("d")).collect()}
    assert out[1]["m"] is None and out[1]["s"] == 0 and out[1]["d"] is None
    assert out[2]["m"] == pytest.approx(3.0) and out[2]["s"] == 15 and out[2]["d"] is None


def test_engineer_full_client_row(spark):
    row = {c: None for c in CLIENT_COLUMNS}
    row.update({"ID_CORRELATIVO": 1, "SDO_ACTIVO_MENOS0": 10, "SDO_ACTIVO_MENOS3": 4, "FLG_SEGURO_MENOS2": 1})
    schema = ", ".join(f"{c} {'string' if c.startswith(('RANG', 'FLAG')) else 'double' if c in ('EDAD', 'ANTIGUEDAD') else 'bigint'}"
                       for c in CLIENT_COLUMNS)
    r = engineer(spark.createDataFrame([tuple(row[c] for c in CLIENT_COLUMNS)], schema)).first()
    assert r["PROM_SDO_ACTIVO_0M_2M"] == 10 and r["PROM_SDO_ACTIVO_3M_5M"] == 4
    assert r["VAR_SDO_ACTIVO_3M"] == 6 and r["PROM_SDO_ACTIVO_6M"] == 7
    assert r["VAR_SDO_ACTIVO_6M"] is None and r["MESES_CON_SEGURO"] == 1 and r["MESES_CON_SALDO"] == 0
    assert r["PROM_NRO_ACCES_CANAL1_6M"] is None


def test_mode_tie_takes_smallest_and_even_median(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("a", 4.0), (None, None)], "s string, x double")
    vals = {r["variable"]: r["value"] for r in fit_table(df, "t", (("s", "moda"), ("x", "mediana"))).collect()}
    assert vals == {"s": "a", "x": "2.5"}


def test_all_null_column_median_is_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert fit_table(df, "t", (("x", "mediana"),)).first()["value"] is None


def test_label_encoder_null_last_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    enc = fit_label_encoder(train, ["c"])
    codes = {r["label"]: r["code"] for r in enc.collect()}
    assert codes == {"a": 0, "b": 1, None: 2}
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = [r["c"] for r in apply_label_encoder(test, enc, ["c"], on_unseen="null").collect()]
    assert got == [0, None, 2]
    kept = [r["c"] for r in apply_label_encoder(test, enc, ["c"], on_unseen="keep").collect()]
    assert kept == [0, 3, 2]
    with pytest.raises(Exception, match="unseen label"):
        apply_label_encoder(test, enc, ["c"], on_unseen="error").collect()


def test_constant_feature_scales_by_one(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "ID_CORRELATIVO long, k double, v double")
    m = fit_standardizer(df, ["k", "v"])
    rows = {r["feature"]: r for r in m.collect()}
    assert rows["k"]["std"] == 0 and rows["v"]["std"] == pytest.approx(1.0)  # population std
    out = apply_standardizer(df, m, ["k", "v"], keep=("ID_CORRELATIVO",)).orderBy("ID_CORRELATIVO").collect()
    assert [r["k"] for r in out] == [0.0, 0.0] and [r["v"] for r in out] == [-1.0, 1.0]


def test_request_profile_null_id_null_verdict_and_client_without_requests(spark):
    reqs = spark.createDataFrame([
        (1, "Reclamo", None, 200101, "p1", "s1"), (1, "Reclamo", "PROCEDE TOTAL", 200101, "p2", "s1"),
        (None, "Solicitud", "NO PROCEDE", 200101, "p1", "s2")],
        "ID_CORRELATIVO long, TIPO_REQUERIMIENTO2 string, DICTAMEN string, CODMES long, "
        "PRODUCTO_SERVICIO_2 string, SUBMOTIVO_2 string")
    cats = {"TIPO_REQUERIMIENTO2": ["Reclamo", "Solicitud"], "DICTAMEN": ["NO PROCEDE", "PROCEDE TOTAL"]}
    prof = request_profile(reqs, categories=cats).collect()
    assert len(prof) == 1  # null id dropped
    r = prof[0].asDict()
    assert r["total_requerimientos"] == 2 and r["nro_dictamenes"] == 1 and r["nro_productos_servicios"] == 2
    assert r["tipo_Reclamo"] == 2 and r["tipo_Solicitud"] == 0 and r["dictamen_NO PROCEDE"] == 0
    # pivot counts + null verdicts = total
    assert r["dictamen_NO PROCEDE"] + r["dictamen_PROCEDE TOTAL"] + 1 == r["total_requerimientos"]
    clients = spark.createDataFrame([(1,), (2,)], "ID_CORRELATIVO long")
    joined = clients.join(request_profile(reqs), "ID_CORRELATIVO", "left").na.fill(0)
    assert joined.where("ID_CORRELATIVO = 2").first()["total_requerimientos"] == 0


def test_risk_band_boundaries(spark):
    df = spark.createDataFrame([(0.415,), (0.285,), (0.2849999,), (None,), (0.9,)], "p double")
    assert [r[0] for r in df.select(risk_band("p")).collect()] == [
        "High risk", "Medium risk", "Low risk", "Low risk", "High risk"]


def test_equal_scores_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.2)], "y int, s double")
    assert roc_auc(df, "y", "s").first()["auc"] == pytest.approx(0.75)
    one = spark.createDataFrame([(1, 0.3), (1, 0.6)], "y int, s double")
    assert roc_auc(one, "y", "s").first()["auc"] is None or math.isnan(roc_auc(one, "y", "s").first()["auc"])
    prf = precision_recall_f1(one, "y", "s", 0.5).first()
    assert prf["precision"] == 1.0 and prf["recall"] == 0.5


def test_youden_ties_take_highest_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "y int, s double")
    # J = 0.5 at 0.9 and at 0.7: the highest threshold wins
    assert youden_threshold(roc_curve(df, "y", "s")).first()["threshold"] == 0.9


def test_rank_duplicate_ids_and_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5), (2, 0.5), (3, 0.9)], "ID_CORRELATIVO long, y_prob double")
    out = sorted((r["order"], r["ID_CORRELATIVO"]) for r in rank_desc(df).collect())
    assert [o for o, _ in out] == [1, 2, 3, 4]
    assert out[0][1] == 3 and out[1][1] == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "ID_CORRELATIVO long, y_prob double")
    assert rank_desc(df).count() == 0
    reqs = spark.createDataFrame([], "ID_CORRELATIVO long, TIPO_REQUERIMIENTO2 string, DICTAMEN string, "
                                     "CODMES long, PRODUCTO_SERVICIO_2 string, SUBMOTIVO_2 string")
    assert request_profile(reqs).count() == 0


def test_null_group_stays_in_grouped_roc(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), (None, 1, 0.8), (None, 0, 0.3)], "g string, y int, s double")
    curve = roc_curve(df, "y", "s", ["g"])
    assert sorted((r.g or "", r.threshold) for r in curve.collect()) == [
        ("", 0.3), ("", 0.8), ("", math.inf), ("a", 0.1), ("a", 0.9), ("a", math.inf)]
    assert {r.g: r.threshold for r in youden_threshold(curve, ["g"]).collect()} == {"a": 0.9, None: 0.8}


def test_grouped_metrics_keep_a_null_sample(spark):
    from retenta.functions.schema import LABEL
    from retenta.plans.batch import evaluate
    df = spark.createDataFrame([("train", 1.0, 0.9), ("train", 0.0, 0.1), (None, 1.0, 0.8), (None, 0.0, 0.3)],
                               f"sample string, {LABEL} double, y_prob double")
    assert {(r["sample"], r["metric"]) for r in evaluate(df, "r", "m").collect()} == {
        (s, m) for s in ("train", None) for m in ("auc", "precision", "recall", "f1", "log_loss")}


def test_class_weight_raises_for_a_null_label(spark):
    from retenta.operators.profiling import with_class_weight
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None)], "id int, y int")
    with pytest.raises(Exception, match="y is null"):
        with_class_weight(df, "y").collect()
    kept = with_class_weight(df.where("y is not null"), "y").collect()
    assert {r.id: r.weight for r in kept} == {1: 1.5, 2: 0.75, 3: 0.75}
