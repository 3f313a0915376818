"""Online scoring events as JSON text.

Event shape (the reference's request body):
``{"body": {"data_cliente": [52 values], "data_requerimiento": [[6 values], ...]}}``
with the client values in positional order (snapshot columns without the
label) and each request as (id, type, verdict, month, product, reason).

Parsing uses ``from_json`` with a declared schema (never ``eval``), then
``element_at`` for the positional client columns and ``inline`` for the
request rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from retenta.functions.schema import (BIGINT_COLUMNS, CLIENT_COLUMNS, DOUBLE_COLUMNS, ID, LABEL,
                                      REQUEST_COLUMNS)

EVENT_CLIENT_COLUMNS = [c for c in CLIENT_COLUMNS if c != LABEL]
EVENT_SCHEMA = T.StructType([T.StructField("body", T.StructType([
    T.StructField("data_cliente", T.ArrayType(T.StringType())),
    T.StructField("data_requerimiento", T.ArrayType(T.ArrayType(T.StringType()))),
]))])
REQUEST_TYPES = {ID: "bigint", "CODMES": "bigint"}


def to_event_json(clients: DataFrame, requests: DataFrame) -> DataFrame:
    """One event per (client, request); clients without requests get one event
    with an empty request list. No per-client collection: an inner join
    (AQE can split a hot client on the request side) plus an anti join
    against the distinct request ids (no skew left after the distinct)."""
    req = requests.select(F.col(ID).alias("__rid"),
                          F.array(*[F.col(c).cast("string") for c in REQUEST_COLUMNS]).alias("__req"))
    client_arr = F.array(*[F.col(c).cast("string") for c in EVENT_CLIENT_COLUMNS]).alias("data_cliente")
    with_req = clients.join(req, clients[ID] == req["__rid"]).select(
        F.struct(client_arr, F.array(F.col("__req")).alias("data_requerimiento")).alias("body"))
    req_ids = requests.select(F.col(ID).alias("__rid")).distinct()
    without = clients.join(req_ids, clients[ID] == req_ids["__rid"], "left_anti").select(
        F.struct(client_arr, F.array().cast("array<array<string>>").alias("data_requerimiento")).alias("body"))
    return with_req.unionByName(without).select(F.to_json(F.struct("body")).alias("value"))


def _typed(name: str, v):
    if name in DOUBLE_COLUMNS:
        return v.try_cast("double")
    if name in BIGINT_COLUMNS:
        return v.try_cast("bigint")
    return v


def parse_events(events: DataFrame, value_col: str = "value",
                 keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """JSON text -> (client rows, request rows). ``keep`` columns ride along (e.g. an event id)."""
    parsed = events.select(*keep, F.from_json(F.col(value_col), EVENT_SCHEMA).alias("e"))
    cl = parsed.select(*keep, *[
        _typed(c, F.element_at(F.col("e.body.data_cliente"), i + 1)).alias(c)
        for i, c in enumerate(EVENT_CLIENT_COLUMNS)])
    reqs = parsed.select(*keep, F.explode(F.col("e.body.data_requerimiento")).alias("r")).select(*keep, *[
        (F.element_at(F.col("r"), i + 1).try_cast(REQUEST_TYPES[c]) if c in REQUEST_TYPES
         else F.element_at(F.col("r"), i + 1)).alias(c)
        for i, c in enumerate(REQUEST_COLUMNS)])
    return cl, reqs
