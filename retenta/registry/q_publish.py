"""Publishing: band, load date, threshold, rank, lift, head sample and the
monthly score table (P17-P19, W1, W5, W7, IO9-IO11)."""

from __future__ import annotations

import uuid

from retenta.functions.scalar import load_date, risk_band, threshold_label
from retenta.functions.schema import ID, LABEL
from retenta.operators.publish import lift_deciles, rank_desc, score_table
from retenta.plans.prepare import apply_prepare, fit_prepare
from retenta.registry import register
from retenta.registry.common import clients, rounded, scores, split_tables, tables
from retenta.registry.sql_prepare import prepare_ctes, scaled_select
from retenta.registry.sql_standins import with_standins
from retenta.session import fresh_path
from retenta.sources.io import publish_table, write_scores_month

BAND_SQL = ("CASE WHEN y_prob >= 0.415 THEN 'High risk' WHEN y_prob >= 0.285 THEN 'Medium risk' "
            "ELSE 'Low risk' END")
RUN_TS = "2024-09-01 03:30:00"
MODEL_NAME = "random_forest"


@register("risk_band", with_standins(f"SELECT ID_CORRELATIVO, y_prob, {BAND_SQL} AS attrition_profile FROM scores"))
def q_risk_band(spark, sf):
    return scores(spark, sf).select(ID, "y_prob", risk_band("y_prob").alias("attrition_profile"))


@register("load_date_lima", """
SELECT event_id, strftime(timezone('America/Lima', ts AT TIME ZONE 'UTC'), '%Y%m%d') AS load_date FROM events""")
def q_load_date_lima(spark, sf):
    e = tables(spark, sf).events
    return e.select("event_id", load_date("ts").alias("load_date"))


@register("threshold_label", with_standins(
    "SELECT ID_CORRELATIVO, CAST(y_prob >= 0.5 AS INTEGER) AS pred FROM scores"))
def q_threshold_label(spark, sf):
    return scores(spark, sf).select(ID, threshold_label("y_prob", 0.5).alias("pred"))


RANK_SQL = ("SELECT ID_CORRELATIVO, y_prob, ATTRITION, CAST(row_number() OVER (ORDER BY y_prob DESC NULLS LAST, "
            "ID_CORRELATIVO) AS BIGINT) AS \"order\" FROM scores")


@register("rank_first_desc", with_standins(RANK_SQL))
def q_rank_first_desc(spark, sf):
    return rank_desc(scores(spark, sf))


@register("lift_deciles", with_standins(
    "SELECT CAST((\"order\" - 1) * 10 // n + 1 AS INTEGER) AS decile, count(*) AS n, "
    "CAST(sum(ATTRITION) AS BIGINT) AS responders, round(avg(ATTRITION), 6) AS response_rate, "
    "round(avg(ATTRITION) / any_value(rate), 6) AS lift FROM (SELECT *, count(*) OVER () AS n, "
    f"avg(ATTRITION) OVER () AS rate FROM ({RANK_SQL})) GROUP BY 1"))
def q_lift_deciles(spark, sf):
    return rounded(lift_deciles(rank_desc(scores(spark, sf)), LABEL))


@register("head_sample", with_standins(
    "SELECT ID_CORRELATIVO, EDAD, ATTRITION FROM clientes ORDER BY ID_CORRELATIVO LIMIT 5"))
def q_head_sample(spark, sf):
    # a 5-row input example is the feature here: TakeOrderedAndProject, no full sort
    return clients(spark, sf).select(ID, "EDAD", LABEL).orderBy(ID).limit(5)


SCORE_SQL = (f"SELECT CAST(ID_CORRELATIVO AS BIGINT) AS ID_CORRELATIVO, y_prob, '{MODEL_NAME}' AS model, "
             f"{BAND_SQL} AS attrition_profile, '20240831' AS load_date, CAST(\"order\" AS BIGINT) AS \"order\", "
             f"200102 AS CODMES FROM ({RANK_SQL})")


@register("score_month", with_standins(SCORE_SQL))
def q_score_month(spark, sf):
    return score_table(scores(spark, sf), MODEL_NAME, RUN_TS, month=200102)


@register("publish_scores", with_standins(SCORE_SQL))
def q_publish_scores(spark, sf):
    """Write the month twice (idempotent overwrite of its partition), register the table, read it back."""
    path = fresh_path(spark, "scores")
    t = score_table(scores(spark, sf), MODEL_NAME, RUN_TS, month=200102)
    write_scores_month(t, path)
    write_scores_month(t, path)
    name = f"retenta_scores_{uuid.uuid4().hex}"
    return publish_table(spark, name, path).select(*t.columns)


@register("sink_raw_scored", with_standins(
    f"SELECT p.*, k.y_prob FROM ({scaled_select('te')}) p JOIN scores k USING (ID_CORRELATIVO)", prepare_ctes()))
def q_sink_raw_scored(spark, sf):
    tr_c, te_c, tr_r, te_r, _ = split_tables(spark, sf)
    _, state = fit_prepare(tr_c, tr_r)
    scored = rounded(apply_prepare(te_c, te_r, state)).join(scores(spark, sf).select(ID, "y_prob"), ID)
    path = fresh_path(spark, "raw_scored")
    scored.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)



@register("sink_scores_month", with_standins(SCORE_SQL))
def q_sink_scores_month(spark, sf):
    """IO9: the month is written twice with dynamic partition overwrite; the folder holds it once."""
    path = fresh_path(spark, "scores_month")
    t = score_table(scores(spark, sf), MODEL_NAME, RUN_TS, month=200102)
    write_scores_month(t, path)
    write_scores_month(t, path)
    return spark.read.parquet(path).select(*t.columns)


@register("publish_table", with_standins(SCORE_SQL))
def q_publish_table(spark, sf):
    """IO10: CREATE TABLE IF NOT EXISTS over the score folder (run twice), read through the catalog."""
    path = fresh_path(spark, "scores_table")
    t = score_table(scores(spark, sf), MODEL_NAME, RUN_TS, month=200102)
    write_scores_month(t, path)
    name = f"retenta_scores_{uuid.uuid4().hex}"
    publish_table(spark, name, path)
    return publish_table(spark, name, path).select(*t.columns)
