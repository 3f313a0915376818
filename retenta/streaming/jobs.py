"""Structured Streaming jobs.

* ``event_features`` / ``score_events``: online events (JSON text) -> client
  columns + request aggregates computed from the event's own request list
  with array functions (no cross-event state) -> fitted preparation state
  (values and a joined label table) -> probability -> risk band.
  The same functions run on a static DataFrame, which is the batch twin.
* ``request_windows`` / ``sliding_activity``: per-client counts per
  tumbling / sliding event-time window with a watermark.
* ``request_windows_exact``: the same counts with exact distinct types, by two
  aggregations in a row; ``session_activity``: sessions that merge as rows arrive;
  ``client_requests``: client events joined in event time with a stream of requests.
  All three emit a row once, when the watermark has passed it (append mode).
* ``dedup_events``: replayed events dropped with
  ``dropDuplicatesWithinWatermark``.
* ``upsert_by_month``: ``foreachBatch`` that merges each micro-batch into the
  months it carries by client, so a month may span micro-batches.

Aggregations run in update mode into ``write_batches``: each micro-batch is
written to its own ``batch=<id>`` folder with overwrite (a retried batch
replaces itself), and ``latest_by_key`` resolves the newest row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.features import engineer
from retenta.functions.scalar import instant_from_utc, risk_band, utc_wall_clock
from retenta.functions.schema import ID, REQUEST_COLUMNS
from retenta.operators.encoding import apply_label_encoder, recode, string_columns
from retenta.operators.imputation import CLIENT_IMPUTATION, apply_imputation, imputation_values
from retenta.operators.requests import DISTINCT_OUTPUTS, PIVOT_PREFIXES, TOTAL, categories_dict
from retenta.operators.scaling import apply_standardizer
from retenta.plans.prepare import PreparedState, clean_clients
from retenta.sources.events import EVENT_SCHEMA, EVENT_CLIENT_COLUMNS, _typed

_REQ_POS = {c: i for i, c in enumerate(REQUEST_COLUMNS)}


def _distinct_in_list(reqs: Column, field: str, fill: Column | None = None) -> Column:
    vals = F.transform(reqs, lambda r: F.coalesce(r[_REQ_POS[field]], fill) if fill is not None else r[_REQ_POS[field]])
    return F.size(F.array_distinct(F.array_compact(vals))).cast("bigint")


def _count_in_list(reqs: Column, field: str, value: str, fill: Column | None = None) -> Column:
    of = lambda r: F.coalesce(r[_REQ_POS[field]], fill) if fill is not None else r[_REQ_POS[field]]
    return F.size(F.filter(reqs, lambda r: of(r) == F.lit(value))).cast("bigint")


def event_features(events: DataFrame, verdict_fill: Column | None = None, value_col: str = "value",
                   categories: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Client columns plus request aggregates of the event's own list.

    ``verdict_fill`` is the imputed verdict, applied inside the list before
    counting; ``categories`` adds the one-hot counts learned at fit time.
    """
    parsed = events.select("*", F.from_json(F.col(value_col), EVENT_SCHEMA).alias("__e"))
    reqs = F.col("__e.body.data_requerimiento")
    cols = [_typed(c, F.element_at(F.col("__e.body.data_cliente"), i + 1)).alias(c)
            for i, c in enumerate(EVENT_CLIENT_COLUMNS)]
    aggs = [F.size(reqs).cast("bigint").alias(TOTAL)]
    for field, name in DISTINCT_OUTPUTS:
        fill = verdict_fill if field == "DICTAMEN" else None
        aggs.append(_distinct_in_list(reqs, field, fill).alias(name))
    for field, prefix in PIVOT_PREFIXES:
        for value in sorted((categories or {}).get(field, ())):
            aggs.append(_count_in_list(reqs, field, value, verdict_fill if field == "DICTAMEN" else None)
                        .alias(f"{prefix}_{value}"))
    return parsed.select(*cols, *aggs)


def prepare_events(events: DataFrame, state: PreparedState) -> DataFrame:
    """Scaled model inputs for each event, using state fitted in batch. A
    missing parameter, moment or vocabulary raises before the stream starts."""
    verdict = imputation_values(state.imputation, "requerimientos", ["DICTAMEN"])["DICTAMEN"]
    names = categories_dict(state.categories) if state.categories is not None else {}
    feats = event_features(events, F.lit(verdict), categories=names)
    c = apply_imputation(clean_clients(feats), imputation_values(
        state.imputation, "clientes", [v for v, _ in CLIENT_IMPUTATION]))
    c = recode(engineer(c))
    # unseen labels must not stop a running stream: they get the next code
    c = apply_label_encoder(c, state.encoder, string_columns(c), on_unseen="keep")
    c = c.na.fill(0)
    return apply_standardizer(c, state.moments, state.features)


def score_events(events: DataFrame, state: PreparedState, model, assembler) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    x = prepare_events(events, state)
    scored = model.transform(assembler.transform(x))
    p = vector_to_array("probability")[1]
    return scored.select(ID, p.alias("y_prob"), risk_band(p).alias("attrition_profile"))


def event_time(events: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as UTC wall-clock time
    (independent of the session time zone)."""
    if dict(events.dtypes).get(col) == "timestamp_ntz":
        return events.withColumn(col, instant_from_utc(F.col(col), events.sparkSession))
    return events


def _utc_text(c) -> Column:
    return F.date_format(utc_wall_clock(c), "yyyy-MM-dd HH:mm:ss")


def request_windows(events: DataFrame, window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Events per client per tumbling window: count and approximate distinct types, updated as rows
    arrive (``request_windows_exact`` counts them exactly, once a window closes)."""
    return (event_time(events).withWatermark("ts", watermark)
            .groupBy(F.col("user_id"), F.window("ts", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.approx_count_distinct("event_type").alias("n_types"))
            .select("user_id", _utc_text(F.col("w.start")).alias("window_start"), "n_events", "n_types"))


def sliding_activity(events: DataFrame, length: str = "10 days", slide: str = "5 days",
                     watermark: str = "1 day", types: Sequence[str] | None = None) -> DataFrame:
    """``types``: the event types to count; all by default."""
    e = event_time(events)
    e = e.where(F.col("event_type").isin(list(types))) if types is not None else e
    return (e.withWatermark("ts", watermark)
            .groupBy("user_id", F.window("ts", length, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select("user_id", _utc_text(F.col("w.start")).alias("window_start"), "n_events"))


def session_activity(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Sessions of a client: rows less than ``gap`` apart. On a stream a session grows and merges with
    others while rows arrive, and comes out once the watermark has passed its end."""
    return (event_time(events).withWatermark("ts", watermark)
            .groupBy("user_id", F.session_window("ts", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select("user_id", _utc_text(F.col("s.start")).alias("session_start"),
                    _utc_text(F.col("s.end")).alias("session_end"), "n_events"))


def request_windows_exact(events: DataFrame, window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Events per client per tumbling window: count and exact distinct types. Two aggregations in a
    row: counts by (client, window, type), then their number and sum by (client, window). Rows
    come out once, when the watermark closes the window (append mode); later rows are dropped. The
    state of a window is a row a client and type, whatever the number of events."""
    by_type = (event_time(events).withWatermark("ts", watermark)
               .groupBy("user_id", "event_type", F.window("ts", window).alias("w")).agg(F.count(F.lit(1)).alias("n")))
    return (by_type.groupBy("user_id", F.window(F.window_time("w"), window).alias("w"))
            .agg(F.sum("n").alias("n_events"), F.count("event_type").alias("n_types"))
            .select("user_id", _utc_text(F.col("w.start")).alias("window_start"), "n_events", "n_types"))


def client_requests(clients: DataFrame, requests: DataFrame, span: str = "200 days", watermark: str = "1 hour") -> DataFrame:
    """Each client event of one stream (client columns, ``client_ts``) with the aggregates of its client's
    requests in another (request columns, ``request_ts``) of the ``span`` before it. An outer join in
    event time: a client without requests comes out, with zeros, once both watermarks have passed
    it. The aggregates of a client are a count and sets of category values, so a client with
    any number of requests keeps a small state after the join. Append mode."""
    c = clients.withWatermark("client_ts", watermark)
    r = requests.select(F.col(ID).alias("__rid"), "request_ts", *[F.col(f).alias(f"__{f}") for f, _ in DISTINCT_OUTPUTS])
    near = (F.col(ID) == F.col("__rid")) & (F.col("request_ts") <= F.col("client_ts")) & (
        F.col("request_ts") >= F.col("client_ts") - F.expr(f"INTERVAL {span}"))
    joined = c.join(r.withWatermark("request_ts", watermark), near, "leftOuter")
    own = [n for n in clients.columns if n != "client_ts"]
    grouped = joined.groupBy(F.col(ID).alias("__id"), F.window("client_ts", "1 hour").alias("__w")).agg(
        F.any_value(F.struct(*own)).alias("__c"), F.count("__rid").alias(TOTAL),
        *[F.size(F.collect_set(f"__{f}")).cast("bigint").alias(name) for f, name in DISTINCT_OUTPUTS])
    return grouped.select("__c.*", TOTAL, *[name for _, name in DISTINCT_OUTPUTS])


def dedup_events(events: DataFrame, key: Sequence[str] = ("event_id",), watermark: str = "1 hour") -> DataFrame:
    return event_time(events).withWatermark("ts", watermark).dropDuplicatesWithinWatermark(list(key))


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update"):
    """Run to completion (availableNow); each micro-batch overwrites its own folder."""
    def sink(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).foreachBatch(sink).start())
    q.awaitTermination()
    return q


def latest_by_key(spark, path: str, keys: Sequence[str]) -> DataFrame:
    df = spark.read.parquet(path)
    values = [c for c in df.columns if c not in keys and c != "batch"]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch")).alias("__v"))
    return latest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])


def write_append(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    q = (stream.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(path))
    q.awaitTermination()
    return q


def upsert_by_month(stream: DataFrame, path: str, checkpoint: str):
    """Monthly score table: each micro-batch replaces its clients' rows in the
    months it carries and leaves the months' other rows, so a month may arrive
    in many micro-batches, and a replayed one changes nothing."""
    from retenta.sources.io import merge_scores_month

    def sink(batch: DataFrame, batch_id: int):
        merge_scores_month(batch, path)
    q = (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(sink).start())
    q.awaitTermination()
    return q
