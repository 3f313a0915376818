"""Spark ML operators: learnable label gives AUC > 0.5; same seed, same output."""

from pyspark.sql import functions as F

from retenta.functions.schema import ID, LABEL
from retenta.operators.evaluation import roc_auc
from retenta.plans import training as T
from retenta.plans.prepare import apply_prepare, fit_prepare
from retenta.registry.common import split_tables
from tests.conftest import SF_MID


def test_forest_learns_a_label_built_from_features(spark):
    tr_c, te_c, tr_r, te_r, _ = split_tables(spark, SF_MID)
    # a label constructed from features: older clients with a recent balance
    relabel = lambda c: c.withColumn(LABEL, ((F.coalesce("EDAD", F.lit(0)) > 45)
                                             | (F.coalesce("SDO_ACTIVO_MENOS0", F.lit(0)) > 300000)).cast("bigint"))
    train, state = fit_prepare(relabel(tr_c), tr_r)
    test = apply_prepare(relabel(te_c), te_r, state)
    model = T.random_forest(numTrees=20).fit(T.training_frame(train, state.features))
    te = T.training_frame(test, state.features, weighted=False)
    p1 = T.predict_proba(model, te)
    auc = roc_auc(p1.join(te.select(ID, LABEL), ID), LABEL, "y_prob").first()["auc"]
    assert auc > 0.8
    p2 = T.predict_proba(T.random_forest(numTrees=20).fit(T.training_frame(train, state.features)), te)
    assert p1.exceptAll(p2).count() == 0


def test_training_and_inference_jobs(spark):
    import uuid
    from retenta.plans.batch import inference_job, training_job
    from retenta.registry.common import clients, requests
    from retenta.session import scratch_path
    from tests.conftest import SF_SMALL
    out = scratch_path(spark, f"t_train_{uuid.uuid4().hex[:6]}")
    c, r = clients(spark, SF_SMALL), requests(spark, SF_SMALL)
    res = training_job(spark, c, r, out, run="t", grids="quick", on_rejected="keep")
    m = res.metrics
    assert {x["model"] for x in m.select("model").distinct().collect()} == {"random_forest", "xgbost"}
    assert m.where("sample = 'test' AND metric = 'auc'").count() == 2
    champ = res.champion.first()
    assert champ["champion"] in ("random_forest", "xgbost")
    # the scoring snapshot has no label column
    scores = inference_job(spark, c.drop("ATTRITION"), r, out, champ["champion"], 200102, "2024-09-01 03:30:00",
                           scratch_path(spark, f"t_scores_{uuid.uuid4().hex[:6]}"))
    assert scores.count() == c.count()
    orders = sorted(x["order"] for x in scores.select("order").collect())
    assert orders == list(range(1, c.count() + 1))


def test_cv_std_is_population_std_of_fold_scores(spark):
    import numpy as np
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from tests.conftest import SF_SMALL
    tr_c, _, tr_r, _, _ = split_tables(spark, SF_SMALL)
    train, state = fit_prepare(tr_c, tr_r)
    tr = T.training_frame(train, state.features, folds=3)
    rf = T.random_forest(numTrees=5)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [2, 4]).build()
    ev = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="probability", numBins=0)
    cvm = CrossValidator(estimator=rf, estimatorParamMaps=grid, evaluator=ev, foldCol="fold",
                         collectSubModels=True).fit(tr)
    for j in range(len(grid)):
        scores = [ev.evaluate(cvm.subModels[f][j].transform(tr.where(F.col("fold") == f))) for f in range(3)]
        assert abs(np.mean(scores) - cvm.avgMetrics[j]) < 1e-9
        assert abs(np.std(scores) - cvm.stdMetrics[j]) < 1e-9


def test_search_equals_separate_fits(spark):
    """Models grown together, in batches, and shorter runs read off longer ones score as fits of their own."""
    import numpy as np
    from retenta.learning import boosting as B
    from retenta.operators.split import kfold_assign
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4)).round(1)
    rows = [(i, float(a[0] + a[1] + rng.normal() > 0), a.tolist()) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, f"{ID} long, {LABEL} double, x array<double>")
    tr = kfold_assign(df, k=3).select(ID, LABEL, "fold", "x")
    points = T.boosted_points({"max_depth": [2, 3], "eta": [0.3], "subsample": [0.7], "n_estimators": [2, 4], "scale_pos_weight": [1, 5]})
    together = T.TOGETHER
    try:
        T.TOGETHER = 5
        T.boosting.vectors, plain = (lambda d, _: d), T.boosting.vectors
        search = T.BoostedSearch(tr, points)
    finally:
        T.TOGETHER, T.boosting.vectors = together, plain
    assert len(search.auc) == 24
    for p in points:
        for f in range(3):
            model = B.fit(tr.where(F.col("fold") != f), p, LABEL, ID, cuts=search.cuts)
            held = model.probabilities(tr.where(F.col("fold") == f), "x", [LABEL])
            assert abs(roc_auc(held, LABEL, "y_prob").first()["auc"] - search.auc[p, f]) < 1e-9
    table = search.results(spark).collect()
    best = max(table, key=lambda r: r.mean_test_score)
    assert best.rank_test_score == 1 and len(table) == 8
    assert abs(best.mean_test_score - np.mean(search.scores(search.best()))) < 1e-12
    assert abs(best.std_test_score - np.std(search.scores(search.best()))) < 1e-12
