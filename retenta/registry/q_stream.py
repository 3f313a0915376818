"""Streaming jobs run to completion on file sources (ST1-ST5); each is
checked against the SQL of its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from retenta.functions.features import engineer
from retenta.registry import register
from retenta.registry.common import clients, requests, rounded, scores
from retenta.registry.q_publish import MODEL_NAME, RUN_TS, SCORE_SQL
from retenta.registry.sql_standins import with_standins
from retenta.session import fresh_path
from retenta.sources import events as ev
from retenta.sources.tables import read_table
from retenta.streaming import jobs


def _run_dir(spark, name):
    return fresh_path(spark, f"stream_{name}")


def _events_stream(spark, sf):
    schema = read_table(spark, sf, "events").schema
    # a glob, so the file source lists the single events file of the folder
    return spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/events.parque[t]")


def write_event_text(spark, sf, path):
    ev.to_event_json(clients(spark, sf), requests(spark, sf)).write.mode("overwrite").text(path)


_EVENT_FEATURES_SQL = """
SELECT k.ID_CORRELATIVO, round(e.PROM_SDO_ACTIVO_6M, 6) AS PROM_SDO_ACTIVO_6M,
       CAST(CASE WHEN r.ID_CORRELATIVO IS NULL THEN 0 ELSE 1 END AS BIGINT) AS total_requerimientos,
       CAST(CASE WHEN r.TIPO_REQUERIMIENTO2 IS NULL THEN 0 ELSE 1 END AS BIGINT) AS nro_tipos_requerimiento,
       CAST(CASE WHEN r.ID_CORRELATIVO IS NULL OR r.DICTAMEN IS NULL THEN 0 ELSE 1 END AS BIGINT) AS nro_dictamenes,
       CAST(CASE WHEN r.PRODUCTO_SERVICIO_2 IS NULL THEN 0 ELSE 1 END AS BIGINT) AS nro_productos_servicios,
       CAST(CASE WHEN r.SUBMOTIVO_2 IS NULL THEN 0 ELSE 1 END AS BIGINT) AS nro_submotivos
FROM clientes k JOIN eng e USING (ID_CORRELATIVO)
LEFT JOIN requerimientos r ON r.ID_CORRELATIVO = k.ID_CORRELATIVO"""


def _eng_cte():
    from retenta.registry.q_features import ENGINEERED_SQL_CTE
    return ENGINEERED_SQL_CTE


@register("stream_event_features", with_standins(_EVENT_FEATURES_SQL, _eng_cte()))
def q_stream_event_features(spark, sf):
    """ST1 feature stage: JSON events streamed from files, request aggregates from each event's list."""
    base = _run_dir(spark, "event_features")
    write_event_text(spark, sf, f"{base}/in")
    stream = spark.readStream.schema("value string").text(f"{base}/in")
    feats = engineer(jobs.event_features(stream))
    out = feats.select("ID_CORRELATIVO", "PROM_SDO_ACTIVO_6M", "total_requerimientos", "nro_tipos_requerimiento",
                       "nro_dictamenes", "nro_productos_servicios", "nro_submotivos")
    jobs.write_append(out, f"{base}/out", f"{base}/ck")
    return rounded(spark.read.parquet(f"{base}/out"))


@register("stream_score_events")
def q_stream_score_events(spark, sf):
    """ST1: fit preparation + forest on the training split, then score the event stream."""
    from retenta.plans import training as T
    from retenta.plans.prepare import fit_prepare
    from retenta.registry.common import split_tables
    tr_c, _, tr_r, _, _ = split_tables(spark, sf)
    prepared, state = fit_prepare(tr_c, tr_r)
    model = T.random_forest().fit(T.training_frame(prepared, state.features))
    base = _run_dir(spark, "score_events")
    write_event_text(spark, sf, f"{base}/in")
    stream = spark.readStream.schema("value string").text(f"{base}/in")
    scored = jobs.score_events(stream, state, model, T.assembler(state.features))
    jobs.write_append(scored, f"{base}/out", f"{base}/ck")
    return spark.read.parquet(f"{base}/out")


@register("stream_request_windows", """
SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_events,
       count(DISTINCT event_type) AS n_types
FROM events GROUP BY 1, 2""")
def q_stream_request_windows(spark, sf):
    base = _run_dir(spark, "request_windows")
    jobs.write_batches(jobs.request_windows(_events_stream(spark, sf)), f"{base}/out", f"{base}/ck")
    return jobs.latest_by_key(spark, f"{base}/out", ["user_id", "window_start"])


@register("stream_sliding_activity", """
WITH e AS (SELECT user_id, CAST(floor(epoch(ts) / 432000) AS BIGINT) * 432000 AS s1 FROM events),
w AS (SELECT user_id, s1 AS s FROM e UNION ALL SELECT user_id, s1 - 432000 FROM e)
SELECT user_id, strftime(make_timestamp(CAST(s AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n_events FROM w GROUP BY 1, 2""")
def q_stream_sliding_activity(spark, sf):
    base = _run_dir(spark, "sliding")
    jobs.write_batches(jobs.sliding_activity(_events_stream(spark, sf)), f"{base}/out", f"{base}/ck")
    return jobs.latest_by_key(spark, f"{base}/out", ["user_id", "window_start"])


def _feed(spark, rows, time, path, slices=4):
    """Rows as a growing folder: ``slices`` writes one after another in the order of ``time``, as a
    source would deliver them. Yields after each write, so a job can run, stop and go on."""
    lo, hi = rows.agg(F.min(time).cast("timestamp").cast("double"), F.max(time).cast("timestamp").cast("double")).first()
    place = F.coalesce(F.floor((F.col(time).cast("timestamp").cast("double") - F.lit(lo)) * slices / F.lit(max(hi - lo, 1.0))), F.lit(0))
    for k in range(slices):
        part = rows.where(F.least(place, F.lit(slices - 1)) == k)
        part.write.mode("append").parquet(path)
        yield k


def _heartbeat(spark, rows, time, path, key):
    """One row of no client (key -1; a null would be dropped before a join), long after the others: it
    moves the watermark past all of them, and never comes out itself."""
    late = rows.agg(F.max(time).alias(time)).select(F.expr(f"{time} + INTERVAL 400 DAYS").alias(time))
    late.select(*[F.col(time) if c == time else F.lit(-1 if c == key else None).cast(t).alias(c) for c, t in rows.dtypes]).coalesce(1).write.mode("append").parquet(path)


def _in_two_runs(spark, rows, job, base, time="ts"):
    """``job`` over the rows as they arrive, stopped half way and restarted from its checkpoint; it
    takes a micro-batch a file. Returns what it appended."""
    def run():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(f"{base}/in")
        jobs.write_append(job(stream), f"{base}/out", f"{base}/ck")
    for k in _feed(spark, rows, time, f"{base}/in"):
        if k == 1:
            run()
    run()
    _heartbeat(spark, rows, time, f"{base}/in", "user_id")
    run()
    return spark.read.parquet(f"{base}/out")


_SESSIONS_SQL = """
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
g AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS n_events
FROM g GROUP BY user_id, sid"""


@register("session_activity", _SESSIONS_SQL)
def q_session_activity(spark, sf):
    """ST4 session part: 30-minute inactivity sessions per client (batch form of the stream job)."""
    return jobs.session_activity(read_table(spark, sf, "events"))


@register("stream_session_activity", _SESSIONS_SQL)
def q_stream_session_activity(spark, sf):
    """ST4: sessions on a stream that arrives in several batches, stopped and restarted half way."""
    events = read_table(spark, sf, "events").select("user_id", "ts")
    return _in_two_runs(spark, events, jobs.session_activity, _run_dir(spark, "sessions"))


@register("stream_exact_types", """
SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_events,
       count(DISTINCT event_type || '-' || CAST(event_id % 12 AS VARCHAR)) AS n_types
FROM events GROUP BY 1, 2""")
def q_stream_exact_types(spark, sf):
    """ST2: exact distinct types per client and day on a stream; types made finer, so there are dozens."""
    fine = F.concat("event_type", F.lit("-"), (F.col("event_id") % 12).cast("string"))
    events = read_table(spark, sf, "events").select("user_id", "ts", fine.alias("event_type"))
    return _in_two_runs(spark, events, jobs.request_windows_exact, _run_dir(spark, "exact_types"))


_JOINED_SQL = """
SELECT k.ID_CORRELATIVO, round(e.PROM_SDO_ACTIVO_6M, 6) AS PROM_SDO_ACTIVO_6M, count(r.ID_CORRELATIVO) AS total_requerimientos,
       count(DISTINCT r.TIPO_REQUERIMIENTO2) AS nro_tipos_requerimiento, count(DISTINCT r.DICTAMEN) AS nro_dictamenes,
       count(DISTINCT r.PRODUCTO_SERVICIO_2) AS nro_productos_servicios, count(DISTINCT r.SUBMOTIVO_2) AS nro_submotivos
FROM clientes k JOIN eng e USING (ID_CORRELATIVO)
LEFT JOIN requerimientos r ON r.ID_CORRELATIVO = k.ID_CORRELATIVO GROUP BY 1, 2"""


@register("stream_client_requests", with_standins(_JOINED_SQL, _eng_cte()))
def q_stream_client_requests(spark, sf):
    """ST1 from two streams: clients' events and their requests of the months before, joined in event time."""
    base = _run_dir(spark, "client_requests")
    month = lambda c: F.to_timestamp(F.concat(F.col(c).cast("string"), F.lit("01")), "yyyyMMdd")
    c = clients(spark, sf).withColumn("client_ts", month("CODMES") + F.expr("INTERVAL 5 DAYS"))
    r = requests(spark, sf).withColumn("request_ts", month("CODMES"))
    for rows, time, name in ((r, "request_ts", "requests"), (c, "client_ts", "clients")):
        for _ in _feed(spark, rows, time, f"{base}/{name}", slices=2):
            pass
        _heartbeat(spark, rows, time, f"{base}/{name}", "ID_CORRELATIVO")
    read = lambda rows, name: spark.readStream.schema(rows.schema).parquet(f"{base}/{name}")
    out = engineer(jobs.client_requests(read(c, "clients"), read(r, "requests")))
    jobs.write_append(out.select("ID_CORRELATIVO", "PROM_SDO_ACTIVO_6M", "total_requerimientos", "nro_tipos_requerimiento", "nro_dictamenes",
                                 "nro_productos_servicios", "nro_submotivos"), f"{base}/out", f"{base}/ck")
    return rounded(spark.read.parquet(f"{base}/out"))


@register("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def q_stream_dedup(spark, sf):
    """Every event is delivered twice (two readers of the same files); replays are dropped."""
    base = _run_dir(spark, "dedup")
    twice = _events_stream(spark, sf).unionByName(_events_stream(spark, sf))
    jobs.write_append(jobs.dedup_events(twice).select("event_id", "user_id", "event_type"),
                      f"{base}/out", f"{base}/ck")
    return spark.read.parquet(f"{base}/out")


@register("stream_monthly_upsert", with_standins(SCORE_SQL))
def q_stream_monthly_upsert(spark, sf):
    """Scores arrive as several files, one to a micro-batch, so the month spans them; the stream is
    then replayed. The table holds every client once."""
    from retenta.operators.publish import score_table
    base = _run_dir(spark, "upsert")
    t = score_table(scores(spark, sf), MODEL_NAME, RUN_TS, month=200102)
    t.repartition(4, "ID_CORRELATIVO").write.mode("overwrite").parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    for run in ("a", "b"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        jobs.upsert_by_month(stream, f"{base}/table", f"{base}/ck_{run}")
    return spark.read.parquet(f"{base}/table").select(*t.columns)
