"""Properties: split partition, scaled moments, rank and AUC identities, and
parity of the distributed global-order path with the one-window form."""

import pytest
from pyspark.sql import Window, functions as F

from retenta.functions.schema import ID, LABEL
from retenta.operators.evaluation import roc_auc, running_sums
from retenta.operators.ordering import row_number_global
from retenta.operators.split import ids_distinct, kfold_assign, split_ids
from retenta.registry.common import clients, scores, split_tables
from tests.conftest import SF_MID, SF_SMALL


def test_split_is_a_partition(spark):
    c = clients(spark, SF_MID)
    s = split_ids(ids_distinct(c), 0.3, 42)
    ids = ids_distinct(c)
    train = s.where("split = 'train'").select(ID)
    test = s.where("split = 'test'").select(ID)
    assert train.intersect(test).count() == 0
    assert train.union(test).exceptAll(ids).count() == 0 and ids.exceptAll(train.union(test)).count() == 0
    assert test.count() == 450


def test_hash_split_roughly_proportional(spark):
    s = split_ids(ids_distinct(clients(spark, SF_MID)), 0.3, 42, mode="hash")
    share = s.where("split = 'test'").count() / s.count()
    assert 0.25 < share < 0.35


def test_folds_are_stratified(spark):
    tr = split_tables(spark, SF_SMALL)[0]
    f = kfold_assign(tr.select(ID, LABEL), 3).groupBy(LABEL, "fold").count().collect()
    by_label = {}
    for r in f:
        by_label.setdefault(r[LABEL], []).append(r["count"])
    for counts in by_label.values():
        assert max(counts) - min(counts) <= 1


def test_scaled_train_has_mean0_std1(spark):
    from retenta.plans.prepare import fit_prepare
    tr_c, _, tr_r, _, _ = split_tables(spark, SF_SMALL)
    prepared, state = fit_prepare(tr_c, tr_r)
    feats = state.features[:10]
    row = prepared.agg(*[F.avg(f"`{f}`").alias(f"m{i}") for i, f in enumerate(feats)],
                       *[F.stddev_pop(f"`{f}`").alias(f"s{i}") for i, f in enumerate(feats)]).first()
    for i in range(len(feats)):
        assert row[f"m{i}"] == pytest.approx(0, abs=1e-9)
        assert row[f"s{i}"] in (pytest.approx(1.0), pytest.approx(0.0))


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_distributed_row_number_equals_window(spark, parts):
    s = scores(spark, SF_MID)
    want = s.select(ID, F.row_number().over(Window.orderBy(F.col("y_prob").desc(), F.col(ID))).alias("rn"))
    got = row_number_global(s, [F.col("y_prob").desc(), F.col(ID)], name="rn", num_partitions=parts)
    assert got.select(ID, "rn").exceptAll(want).count() == 0 and got.count() == want.count()


def test_distributed_partitioned_row_number_equals_window(spark):
    s = scores(spark, SF_MID)
    w = Window.partitionBy(LABEL).orderBy(F.col("y_prob").desc(), F.col(ID))
    want = s.select(ID, F.row_number().over(w).alias("rn"))
    got = row_number_global(s, [F.col("y_prob").desc(), F.col(ID)], partition_cols=[LABEL], name="rn",
                            num_partitions=5)
    assert got.select(ID, "rn").exceptAll(want).count() == 0


def test_running_sums_equal_window(spark):
    s = scores(spark, SF_MID).groupBy("y_prob").agg(F.sum(LABEL).alias("pos"))
    want = s.select("y_prob", F.sum("pos").over(
        Window.orderBy(F.col("y_prob").desc()).rowsBetween(Window.unboundedPreceding, 0)).alias("pos_cum"))
    got = running_sums(s, ["pos"], [F.col("y_prob").desc()], num_partitions=6).select("y_prob", "pos_cum")
    assert got.exceptAll(want).count() == 0


def test_auc_of_reversed_score(spark):
    s = scores(spark, SF_MID)
    a = roc_auc(s, LABEL, "y_prob").first()["auc"]
    b = roc_auc(s.withColumn("r", 1 - F.col("y_prob")), LABEL, "r").first()["auc"]
    assert a + b == pytest.approx(1.0)


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    s = scores(spark, SF_MID).select(F.col(LABEL).cast("double").alias("label"), F.col("y_prob").alias("raw"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    assert roc_auc(s, "label", "raw").first()["auc"] == pytest.approx(ev.evaluate(s), abs=1e-9)
