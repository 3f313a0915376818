"""Fitted state: one path whatever its size, and errors in place of silent gaps."""

import pytest
from pyspark.sql import functions as F

from retenta.operators.encoding import apply_label_encoder, fit_label_encoder
from retenta.operators.imputation import fit_imputation, fit_table, imputation_values
from retenta.operators.scaling import apply_standardizer, fit_standardizer, moment_values
from retenta.plans.batch import RejectedChampion, training_job
from retenta.session import ensure_checkpoint_dir, fresh_path


def _frame(spark):
    return spark.createDataFrame([(1, "b", 2.0), (2, "a", 4.0), (3, None, 9.0), (4, "a", 1.0)],
                                 "ID_CORRELATIVO long, c string, x double")


def test_encoder_takes_any_number_of_labels(spark):
    df = spark.range(30_000).select(F.col("id").alias("ID_CORRELATIVO"), F.format_string("%08d", F.col("id")).alias("c"))
    out = apply_label_encoder(df, fit_label_encoder(df, ["c"]), ["c"])
    assert out.where("c <> ID_CORRELATIVO").count() == 0 and out.count() == 30_000


def test_encoder_plan_has_no_window_over_labels(spark):
    df = _frame(spark)
    plan = fit_label_encoder(df, ["c"])._jdf.queryExecution().toString()
    assert "label" not in [w for w in plan.split("Window ") if "partitionBy" in w][:1]


def test_a_missing_moment_raises(spark):
    df = _frame(spark)
    m = fit_standardizer(df, ["x"])
    assert set(moment_values(m, ["x"])) == {"x"}
    with pytest.raises(ValueError, match="y"):
        apply_standardizer(df.withColumn("y", F.lit(1.0)), m, ["x", "y"], keep=("ID_CORRELATIVO",))


def test_many_features_in_blocks(spark):
    df = spark.range(50).select(*[(F.col("id") * i).cast("double").alias(f"f{i}") for i in range(40)])
    m = moment_values(fit_standardizer(df, df.columns), df.columns)
    assert len(m) == 40 and m["f3"][0] == 24.5 * 3 and m["f0"][1] == 0


def test_one_variable_in_two_tables_keeps_both(spark):
    params = spark.createDataFrame([("a", "X", "moda", "1"), ("b", "X", "moda", "2"), ("a", "Y", "moda", "3")],
                                   "dataframe string, variable string, strategy string, value string")
    assert imputation_values(params, "a", ["X", "Y"]) == {"X": "1", "Y": "3"}
    with pytest.raises(ValueError, match="Y"):
        imputation_values(params, "b", ["X", "Y"])
    with pytest.raises(ValueError, match="several"):
        imputation_values(params.union(params), "a", ["X"])


def test_median_and_mode_of_a_near_unique_column(spark):
    df = spark.range(1, 10_001).select(F.col("id").cast("double").alias("x"), F.col("id").cast("string").alias("s"))
    got = {r["variable"]: r["value"] for r in fit_table(df, "t", (("s", "moda"), ("x", "mediana"))).collect()}
    assert got == {"s": "1", "x": "5000.5"}


def test_library_code_raises_without_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_a_rejected_champion_stops_the_job(spark):
    from retenta.registry.common import clients, requests
    from tests.conftest import SF_SMALL
    c, r = clients(spark, SF_SMALL), requests(spark, SF_SMALL)
    other = c.withColumn("CODMES", F.lit(200001).cast("bigint"))
    out = fresh_path(spark, "t_rejected")
    with pytest.raises(RejectedChampion):
        training_job(spark, c.unionByName(other), r, out, run="t", grids="quick", gate=1.1, month=200102, join_how="inner",
                     with_pivot_counts=True)
    # one month of the two, and only clients with requests
    n = c.join(r, "ID_CORRELATIVO", "left_semi").count()
    assert spark.read.parquet(f"{out}/split/clients").count() == n
    # the one-hot variant is scored from stored state
    from retenta.plans.batch import inference_features
    prepared, state = inference_features(spark, c.unionByName(other), r, out, 200102)
    assert state.join_how == "inner" and any(f.startswith("dictamen_") for f in state.features)
    assert prepared.count() == n and set(state.features) <= set(prepared.columns)


def test_imputation_of_both_tables(spark):
    from retenta.registry.common import clients, requests
    from tests.conftest import SF_SMALL
    rows = fit_imputation(clients(spark, SF_SMALL), requests(spark, SF_SMALL)).collect()
    assert len(rows) == 5 and all(r["value"] for r in rows)
