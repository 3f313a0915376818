"""Evaluation and model selection (W2-W4, W6, E1-E8, F4, F6, P20) on the
deterministic score of the stand-in clients."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from retenta.functions.schema import ID, LABEL
from retenta.operators.evaluation import (classification_report, confusion_matrix, join_groups, log_loss,
                                          precision_recall_f1, quality_gate, roc_auc, roc_curve, select_champion,
                                          youden_threshold)
from retenta.operators.split import kfold_assign
from retenta.registry import register
from retenta.registry.common import clients, rounded, scores, split_assignment, split_tables
from retenta.registry.sql_eval import SCORE_B_SQL, eval_ctes
from retenta.registry.sql_prepare import SPLIT_CTES
from retenta.registry.sql_standins import with_standins

ALL = "SELECT 'all' AS grp, ATTRITION AS y, y_prob AS s FROM scores"
ALL_CTES = f"src AS ({ALL}),{eval_ctes('e', 'src')}"


def _ys(spark, sf) -> DataFrame:
    return scores(spark, sf).select(ID, F.col(LABEL).alias("y"), F.col("y_prob").alias("s"))


@register("roc_curve", with_standins(
    "SELECT threshold, tp, fp, P, N, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM e_roc", ALL_CTES))
def q_roc_curve(spark, sf):
    return rounded(roc_curve(_ys(spark, sf), "y", "s"))


@register("youden_threshold", with_standins(
    "SELECT threshold, round(youden_j, 6) AS youden_j FROM e_youden", ALL_CTES))
def q_youden_threshold(spark, sf):
    return rounded(youden_threshold(roc_curve(_ys(spark, sf), "y", "s")))


@register("roc_auc", with_standins("SELECT round(auc, 6) AS auc FROM e_auc", ALL_CTES))
def q_roc_auc(spark, sf):
    return rounded(roc_auc(_ys(spark, sf), "y", "s"))


@register("log_loss", with_standins(
    "SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss FROM (SELECT y, "
    "least(greatest(s, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM src)", ALL_CTES))
def q_log_loss(spark, sf):
    return rounded(log_loss(_ys(spark, sf), "y", "s"))


@register("confusion_matrix", with_standins(
    "SELECT a.actual, p.predicted, CAST(count(r.y) AS BIGINT) AS n FROM (VALUES (0), (1)) a(actual) "
    "CROSS JOIN (VALUES (0), (1)) p(predicted) LEFT JOIN src r ON r.y = a.actual "
    "AND (CASE WHEN r.s >= 0.5 THEN 1 ELSE 0 END) = p.predicted GROUP BY 1, 2", ALL_CTES))
def q_confusion_matrix(spark, sf):
    return confusion_matrix(_ys(spark, sf), "y", "s", 0.5)


def _at_youden(spark, sf, fn):
    ys = _ys(spark, sf)
    t = youden_threshold(roc_curve(ys, "y", "s")).select(F.col("threshold").alias("__t"))
    return fn(ys.crossJoin(F.broadcast(t)), "y", "s", "__t")


@register("precision_recall_f1", with_standins(
    "SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM e_prf", ALL_CTES))
def q_precision_recall_f1(spark, sf):
    return rounded(_at_youden(spark, sf, precision_recall_f1))


@register("classification_report", with_standins("""
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
 SELECT '0' AS class, CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS precision,
        CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS recall,
        CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END AS f1,
        CAST(tn + fp AS DOUBLE) AS support FROM e_cm
 UNION ALL SELECT '1', p.precision, p.recall, p.f1, CAST(tp + fn AS DOUBLE) FROM e_cm JOIN e_prf p USING (grp)
 UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn),
        (tp + tn) / (tp + tn + fp + fn), CAST(tp + tn + fp + fn AS DOUBLE) FROM e_cm
 UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m
 UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM m)
""", ALL_CTES + """,
m AS (SELECT CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, p.precision AS p1,
      CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0, p.recall AS r1,
      CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END AS f0, p.f1 AS f1,
      CAST(tn + fp AS DOUBLE) AS s0, CAST(tp + fn AS DOUBLE) AS s1, CAST(tp + tn + fp + fn AS DOUBLE) AS n
      FROM e_cm JOIN e_prf p USING (grp))"""))
def q_classification_report(spark, sf):
    return rounded(_at_youden(spark, sf, classification_report))


SPLIT_SRC = ("src AS (SELECT s.split AS grp, k.ATTRITION AS y, k.y_prob AS s FROM scores k "
             "JOIN split s USING (ID_CORRELATIVO))")


@register("train_vs_test_auc", with_standins(
    "SELECT grp AS split, round(auc, 6) AS auc FROM e_auc", SPLIT_CTES + "," + SPLIT_SRC + "," + eval_ctes("e", "src")))
def q_train_vs_test_auc(spark, sf):
    s = split_assignment(spark, sf)
    ys = _ys(spark, sf).join(s, ID)
    return rounded(roc_auc(ys, "y", "s", ["split"]))


# ---- model comparison: two deterministic scores x {train, test} -------------------------------

MODELS_SRC = ("src AS (SELECT 'random_forest|' || s.split AS grp, k.ATTRITION AS y, k.y_prob AS s FROM scores k "
              "JOIN split s USING (ID_CORRELATIVO) UNION ALL SELECT 'xgbost|' || s.split, c.ATTRITION, "
              f"{SCORE_B_SQL.replace('k.', 'c.')} FROM clientes c JOIN split s USING (ID_CORRELATIVO))")
METRICS_SQL = ("metrics AS (SELECT 'r1' AS run, split_part(grp, '|', 1) AS model, split_part(grp, '|', 2) AS sample, "
               "metric, value FROM (SELECT grp, auc, recall, f1 FROM e_auc JOIN e_prf USING (grp)) "
               "UNPIVOT (value FOR metric IN (auc, recall, f1)))")
MODELS_CTES = SPLIT_CTES + "," + MODELS_SRC + "," + eval_ctes("e", "src") + "," + METRICS_SQL


def metrics_table(spark, sf) -> DataFrame:
    """(run, model, sample, metric, value): AUC, recall and F1 at each sample's Youden threshold."""
    s = split_assignment(spark, sf)
    c = clients(spark, sf)
    a = _ys(spark, sf).join(s, ID).select(F.concat(F.lit("random_forest|"), "split").alias("grp"), "y", "s")
    b = c.join(s, ID).select(F.concat(F.lit("xgbost|"), "split").alias("grp"), F.col(LABEL).alias("y"),
                             (F.lit(1.0) / (1 + F.coalesce(F.col("NRO_ENTID_SSFF_MENOS0"), F.lit(0)))).alias("s"))
    ys = a.unionByName(b)
    t = youden_threshold(roc_curve(ys, "y", "s", ["grp"]), ["grp"]).select("grp", F.col("threshold").alias("__t"))
    prf = precision_recall_f1(join_groups(ys, F.broadcast(t), ["grp"]), "y", "s", "__t", ["grp"])
    auc = roc_auc(ys, "y", "s", ["grp"])
    wide = join_groups(auc, prf, ["grp"])
    long = wide.selectExpr("grp", "stack(3, 'auc', auc, 'recall', recall, 'f1', f1) AS (metric, value)")
    return long.select(F.lit("r1").alias("run"), F.split_part("grp", F.lit("|"), F.lit(1)).alias("model"),
                       F.split_part("grp", F.lit("|"), F.lit(2)).alias("sample"), "metric", "value")


@register("filter_metric_sample", with_standins(
    "SELECT run, model, sample, metric, round(value, 6) AS value FROM metrics WHERE sample = 'test'", MODELS_CTES))
def q_filter_metric_sample(spark, sf):
    return rounded(metrics_table(spark, sf).where(F.col("sample") == "test"))


# On equal metric the random forest wins (checked first).
PRIORITY = {"random_forest": 0, "xgbost": 1}

_CHAMP_SQL = ("SELECT run, model AS champion, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY "
              "run ORDER BY value DESC, CASE model WHEN 'random_forest' THEN 0 ELSE 1 END) AS rn FROM metrics "
              "WHERE sample = 'test' AND metric = '{m}') WHERE rn = 1")


@register("select_champion", with_standins(_CHAMP_SQL.format(m="recall"), MODELS_CTES))
def q_select_champion(spark, sf):
    m = metrics_table(spark, sf).where(F.col("sample") == "test")
    return rounded(select_champion(m, "recall", PRIORITY))


@register("select_champion_auc", with_standins(_CHAMP_SQL.format(m="auc"), MODELS_CTES))
def q_select_champion_auc(spark, sf):
    m = metrics_table(spark, sf).where(F.col("sample") == "test")
    return rounded(select_champion(m, "auc", PRIORITY))


@register("quality_gate", with_standins(
    f"SELECT run, champion, value, value >= 0.6 AS accepted FROM ({_CHAMP_SQL.format(m='recall')})", MODELS_CTES))
def q_quality_gate(spark, sf):
    m = metrics_table(spark, sf).where(F.col("sample") == "test")
    return quality_gate(rounded(select_champion(m, "recall", PRIORITY)), 0.6)


# ---- cross-validation table over candidate scores ---------------------------------------------

CANDIDATES_SQL = ("folds AS (SELECT ID_CORRELATIVO, (row_number() OVER (PARTITION BY ATTRITION ORDER BY "
                  "md5('42:' || CAST(ID_CORRELATIVO AS VARCHAR)), ID_CORRELATIVO) - 1) % 3 AS fold FROM tr_c),"
                  "cand AS (SELECT k.ID_CORRELATIVO, k.ATTRITION AS y, f.fold, c.name, CASE c.name "
                  "WHEN 'acctbal' THEN k.y_prob WHEN 'suppliers' THEN " + SCORE_B_SQL.replace("k.", "x.") + " "
                  "WHEN 'blend' THEN (k.y_prob + " + SCORE_B_SQL.replace("k.", "x.") + ") / 2 "
                  "WHEN 'blend_copy' THEN (k.y_prob + " + SCORE_B_SQL.replace("k.", "x.") + ") / 2 "
                  "ELSE 1 - k.y_prob END AS s "
                  "FROM scores k JOIN clientes x USING (ID_CORRELATIVO) JOIN folds f USING (ID_CORRELATIVO) "
                  "CROSS JOIN (VALUES ('acctbal'), ('suppliers'), ('blend'), ('blend_copy'), ('reversed')) c(name)),"
                                    "src AS (SELECT name || '|' || CAST(fold AS VARCHAR) AS grp, y, s FROM cand)")
CV_SQL = ("cv AS (SELECT name AS params, avg(auc) AS mean_test_score, stddev_pop(auc) AS std_test_score "
          "FROM (SELECT split_part(grp, '|', 1) AS name, auc FROM e_auc) GROUP BY name),"
          "cvr AS (SELECT params, round(mean_test_score, 6) AS mean_test_score, "
          "round(std_test_score, 6) AS std_test_score, round(std_test_score / mean_test_score, 6) AS cv, "
          "CAST(rank() OVER (ORDER BY round(mean_test_score, 12) DESC) AS INTEGER) AS rank_test_score FROM cv)")
CV_CTES = SPLIT_CTES + "," + CANDIDATES_SQL + "," + eval_ctes("e", "src") + "," + CV_SQL

def candidate_scores(spark, sf) -> DataFrame:
    """(name, fold, y, s): every candidate score of every training client, with its fold."""
    tr_c = split_tables(spark, sf)[0]
    folds = kfold_assign(tr_c.select(ID, LABEL), k=3).select(ID, "fold")
    c = clients(spark, sf).select(ID, "NRO_ENTID_SSFF_MENOS0")
    base = scores(spark, sf).join(c, ID).join(folds, ID)
    b = F.lit(1.0) / (1 + F.coalesce(F.col("NRO_ENTID_SSFF_MENOS0"), F.lit(0)))
    exprs = {"acctbal": F.col("y_prob"), "suppliers": b, "blend": (F.col("y_prob") + b) / 2,
             "blend_copy": (F.col("y_prob") + b) / 2, "reversed": 1 - F.col("y_prob")}
    parts = [base.select(F.lit(n).alias("name"), "fold", F.col(LABEL).alias("y"), e.alias("s"))
             for n, e in exprs.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return long


def cv_table(spark, sf) -> DataFrame:
    auc = roc_auc(candidate_scores(spark, sf), "y", "s", ["name", "fold"])
    cv = auc.groupBy(F.col("name").alias("params")).agg(F.avg("auc").alias("mean_test_score"),
                                                        F.stddev_pop("auc").alias("std_test_score"))
    # one row per grid point: the window is over the (small) grid, not the data
    w = Window.orderBy(F.round("mean_test_score", 12).desc())
    return cv.select("params", F.round("mean_test_score", 6).alias("mean_test_score"),
                     F.round("std_test_score", 6).alias("std_test_score"),
                     F.round(F.try_divide(F.col("std_test_score"), F.col("mean_test_score")), 6).alias("cv"),
                     F.rank().over(w).cast("int").alias("rank_test_score"))


@register("cv_rank_min", with_standins("SELECT * FROM cvr", CV_CTES))
def q_cv_rank_min(spark, sf):
    return cv_table(spark, sf)


@register("coef_variation", with_standins("SELECT params, cv FROM cvr", CV_CTES))
def q_coef_variation(spark, sf):
    return cv_table(spark, sf).select("params", "cv")


@register("filter_best_rank", with_standins("SELECT * FROM cvr WHERE rank_test_score = 1", CV_CTES))
def q_filter_best_rank(spark, sf):
    return cv_table(spark, sf).where("rank_test_score = 1")


@register("latest_version", with_standins(
    "SELECT name, max(fold + 1) AS version FROM (SELECT split_part(grp, '|', 1) AS name, "
    "CAST(split_part(grp, '|', 2) AS INTEGER) AS fold, CASE WHEN auc >= 0.5 THEN 'development' ELSE 'archived' END "
    "AS tag FROM e_auc) WHERE tag = 'development' GROUP BY name", CV_CTES))
def q_latest_version(spark, sf):
    """Each (candidate, fold) fit is registered as a version, tagged by its AUC; the table then gives
    the latest development version per name."""
    from retenta.session import fresh_path
    from retenta.sources.versions import latest_versions, register_version
    root = fresh_path(spark, "model-registry")
    fits = roc_auc(candidate_scores(spark, sf), "y", "s", ["name", "fold"]).orderBy("name", "fold")
    for r in fits.collect():  # a row a candidate and fold
        register_version(spark, root, r["name"], "development" if r["auc"] >= 0.5 else "archived", root, {"auc": r["auc"]}, f"fold{r['fold']}")
    return latest_versions(spark, root)


# ---- second label / score pair: document quality against document length -----------------------

DOC_SRC = ("src AS (SELECT 'all' AS grp, l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s "
           "FROM labels l JOIN documents d ON d.doc_id = l.doc_id)")


def _doc_ys(spark, sf) -> DataFrame:
    from retenta.registry.common import tables
    t = tables(spark, sf)
    return t.labels.select("doc_id", F.col("quality").alias("y")).join(
        t.documents.select("doc_id", F.col("n_chars").cast("double").alias("s")), "doc_id")


@register("roc_auc_quality_length", f"WITH {DOC_SRC},{eval_ctes('e', 'src')} SELECT round(auc, 6) AS auc FROM e_auc")
def q_roc_auc_quality_length(spark, sf):
    """Exact AUC of document length as a score for the quality label (continuous scores)."""
    return rounded(roc_auc(_doc_ys(spark, sf), "y", "s"))


@register("youden_quality_length",
          f"WITH {DOC_SRC},{eval_ctes('e', 'src')} SELECT threshold, round(youden_j, 6) AS youden_j FROM e_youden")
def q_youden_quality_length(spark, sf):
    return rounded(youden_threshold(roc_curve(_doc_ys(spark, sf), "y", "s")))


@register("select_champion_f1", with_standins(_CHAMP_SQL.format(m="f1"), MODELS_CTES))
def q_select_champion_f1(spark, sf):
    """Champion by test F1 (the local tracked variant's rule)."""
    m = metrics_table(spark, sf).where(F.col("sample") == "test")
    return rounded(select_champion(m, "f1", PRIORITY))
