"""Exact binary-classification evaluation over (label, score) tables.

Everything starts from scores grouped to distinct values (pos / neg counts
per score), which shrinks the input before any ordering; the running sums
over descending scores use the range-partitioned scale path, and argmax
choices use ``max_by`` (a partial aggregate) instead of a global window.
Counts stay integers, so ties in Youden's J are compared exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from retenta.operators.ordering import running_sums

# Default clip of log loss = machine epsilon of float64.
FLOAT64_EPS = 2.220446049250313e-16


def join_groups(left: DataFrame, right: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Inner join on the group columns in which a null group meets itself."""
    keys = [f"__g{i}" for i in range(len(group_cols))]
    named = right.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(group_cols, keys, strict=True)],
                         *[F.col(f"`{c}`") for c in right.columns if c not in group_cols])
    cond = [F.col(f"`{c}`").eqNullSafe(F.col(k)) for c, k in zip(group_cols, keys, strict=True)]
    return left.join(named, cond).drop(*keys)


def score_counts(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return (df.where(F.col(score).isNotNull())
            .groupBy(*group_cols, F.col(score).alias("threshold"))
            .agg(F.sum(F.col(label).cast("bigint")).alias("pos"),
                 F.sum((1 - F.col(label)).cast("bigint")).alias("neg")))


def roc_curve(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = (),
              with_origin: bool = True) -> DataFrame:
    """(group..., threshold, tp, fp, P, N, tpr, fpr) for every distinct score, highest first,
    plus the origin point at threshold +inf."""
    g = list(group_cols)
    sc = score_counts(df, label, score, g)
    cum = running_sums(sc, ["pos", "neg"], [F.col("threshold").desc()], partition_cols=g)
    totals = sc.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    curve = cum.select(*g, "threshold", F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"))
    if with_origin:
        origin = totals.select(*g, F.lit(float("inf")).alias("threshold"),
                               F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"))
        curve = curve.unionByName(origin.select(*g, "threshold", "tp", "fp"))
    out = join_groups(curve, totals, g) if g else curve.crossJoin(totals)
    return out.select(*g, "threshold", "tp", "fp", "P", "N",
                      F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")).alias("tpr"),
                      F.try_divide(F.col("fp").cast("double"), F.col("N").cast("double")).alias("fpr"))


def youden_threshold(roc: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """argmax of TPR - FPR, ties to the highest threshold; J compared as tp*N - fp*P."""
    j = (F.col("tp").cast("decimal(38,0)") * F.col("N") - F.col("fp").cast("decimal(38,0)") * F.col("P"))
    return (roc.groupBy(*group_cols)
            .agg(F.max_by("threshold", F.struct(j, F.col("threshold"))).alias("threshold"),
                 F.max_by(F.col("tpr") - F.col("fpr"), F.struct(j, F.col("threshold"))).alias("youden_j")))


def roc_auc(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC with ties counted 1/2 (Mann-Whitney), per group.

    AUC = sum_s neg_s * (pos_above_s + pos_s / 2) / (P * N), where pos_above_s
    counts positives with a strictly higher score.
    """
    g = list(group_cols)
    sc = score_counts(df, label, score, g)
    cum = running_sums(sc, ["pos"], [F.col("threshold").desc()], partition_cols=g)
    d = "decimal(38,0)"
    twice = (2 * (F.col("pos_cum") - F.col("pos")).cast(d) + F.col("pos").cast(d)) * F.col("neg").cast(d)
    agg = cum.groupBy(*g).agg(F.sum(twice).alias("num2"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # single-class input has no ROC: null
    return agg.select(*g, F.try_divide(F.col("num2").cast("double"),
                                       2.0 * F.col("P").cast("double") * F.col("N").cast("double")).alias("auc"))


def log_loss(df: DataFrame, label: str, score: str, eps: float = FLOAT64_EPS,
             group_cols: Sequence[str] = ()) -> DataFrame:
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.groupBy(*group_cols).agg(
        F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"))


def _cells(label: str, pred):
    y = F.col(label)
    return {
        "tn": F.sum(((y == 0) & (pred == 0)).cast("bigint")),
        "fp": F.sum(((y == 0) & (pred == 1)).cast("bigint")),
        "fn": F.sum(((y == 1) & (pred == 0)).cast("bigint")),
        "tp": F.sum(((y == 1) & (pred == 1)).cast("bigint")),
    }


def _pred(score: str, threshold):
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    return (F.col(score) >= t).cast("int")


def confusion_counts(df: DataFrame, label: str, score: str, threshold, group_cols: Sequence[str] = ()) -> DataFrame:
    """Wide counts tn, fp, fn, tp (zero cells included)."""
    cells = _cells(label, _pred(score, threshold))
    return df.groupBy(*group_cols).agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in cells.items()])


def confusion_matrix(df: DataFrame, label: str, score: str, threshold, group_cols: Sequence[str] = ()) -> DataFrame:
    """Long form (actual, predicted, n) with all four cells."""
    w = confusion_counts(df, label, score, threshold, group_cols)
    return w.selectExpr(*[f"`{c}`" for c in group_cols],
                        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, n)")


def _safe_div(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b, F.lit(0)).cast("double")), F.lit(0.0))


def precision_recall_f1(df: DataFrame, label: str, score: str, threshold,
                        group_cols: Sequence[str] = ()) -> DataFrame:
    """Positive-class precision, recall and F1; 0 where a denominator is 0."""
    c = confusion_counts(df, label, score, threshold, group_cols)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(*group_cols, _safe_div(tp, tp + fp).alias("precision"),
                    _safe_div(tp, tp + fn).alias("recall"),
                    _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def classification_report(df: DataFrame, label: str, score: str, threshold) -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' with precision, recall, f1, support."""
    c = confusion_counts(df, label, score, threshold)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    n = tp + fp + fn + tn
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    f0 = _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    acc = _safe_div(tp + tn, n)
    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("double").alias("support"))
    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
            _safe_div(f0 * s0 + f1 * s1, n), n),
    )
    return c.select(F.inline(rows))


def select_champion(metrics: DataFrame, metric: str, priority: dict[str, int],
                    run_col: str = "run", model_col: str = "model") -> DataFrame:
    """Per run, the model with the highest ``metric``; ties go to the lowest priority number."""
    m = metrics.where(F.col("metric") == metric)
    prio = F.coalesce(*[F.when(F.col(model_col) == k, F.lit(v)) for k, v in priority.items()], F.lit(1 << 30))
    order = F.struct(F.col("value"), -prio)
    return m.groupBy(run_col).agg(F.max_by(model_col, order).alias("champion"),
                                  F.max_by("value", order).alias("value"))


def quality_gate(champions: DataFrame, min_value: float = 0.6) -> DataFrame:
    return champions.withColumn("accepted", F.col("value") >= F.lit(min_value))
