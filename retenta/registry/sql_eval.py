"""DuckDB SQL for the evaluation family over a relation ``{src}(grp, y, s)``.

Independent forms: AUC from negatives strictly below each score (the Spark
code counts positives strictly above), Youden by a window ``row_number``
(the Spark code uses ``max_by``)."""

from __future__ import annotations


def eval_ctes(p: str, src: str) -> str:
    return f"""
{p}_sc AS (SELECT grp, s AS threshold, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
           FROM {src} WHERE s IS NOT NULL GROUP BY grp, s),
{p}_tot AS (SELECT grp, CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N FROM {p}_sc GROUP BY grp),
{p}_cum AS (SELECT grp, threshold,
    CAST(sum(pos) OVER (PARTITION BY grp ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
    CAST(sum(neg) OVER (PARTITION BY grp ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp
    FROM {p}_sc
    UNION ALL SELECT grp, CAST('inf' AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM {p}_tot),
{p}_roc AS (SELECT c.grp, c.threshold, c.tp, c.fp, t.P, t.N, c.tp / t.P AS tpr, c.fp / t.N AS fpr
    FROM {p}_cum c JOIN {p}_tot t USING (grp)),
{p}_youden AS (SELECT grp, threshold, tpr - fpr AS youden_j FROM (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY CAST(tp AS HUGEINT) * N - CAST(fp AS HUGEINT) * P DESC,
    threshold DESC) AS rn FROM {p}_roc) WHERE rn = 1),
{p}_auc AS (SELECT grp, sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auc FROM (
    SELECT grp, threshold, pos, neg, coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY threshold
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM {p}_sc) GROUP BY grp),
{p}_cm AS (SELECT r.grp, CAST(sum(CASE WHEN y = 0 AND s < t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tn,
    CAST(sum(CASE WHEN y = 0 AND s >= t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN y = 1 AND s < t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fn,
    CAST(sum(CASE WHEN y = 1 AND s >= t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp
    FROM {src} r JOIN {p}_youden t USING (grp) GROUP BY r.grp),
{p}_prf AS (SELECT grp, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM {p}_cm)"""


# deterministic second score: fewer recent suppliers -> higher score
SCORE_B_SQL = "1.0 / (1 + coalesce(k.NRO_ENTID_SSFF_MENOS0, 0))"
