"""Client snapshot and request log built from the driver tables.

The reference reads a wide monthly client snapshot (one row per client and
month, six lags encoded in column names) and a long request log. Neither is
in the driver data, so both are derived here with Spark from
customer / orders / lineitem / part / events / nation / region, following
the mapping documented in FIXTURES.md section 2.

Scale notes
* Every per-client measure is one conditional aggregate keyed by the client:
  one shuffle with map-side partial aggregation per source table, so a client
  holding a third of all orders is combined before the shuffle.
* Only nation (25 rows) and region (5 rows) are broadcast: fixed-size
  dimensions of the TPC-H schema.
* The request log filters ``o_orderdate`` with a date range that reaches the
  Parquet scan as a pushed filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.scalar import ntz_literal
from retenta.functions.schema import CLIENT_COLUMNS, ID, MONTH, N_LAGS, lag_cols
from retenta.sources.tables import Tables

# Fixed parameters of the stand-in (FIXTURES.md section 2).
ANCHOR_MONTH = 200102            # snapshot month CODMES
OUTCOME_START = "2001-03-01"     # ATTRITION = no order on or after this day
REQUEST_RANGE = (200009, 200102)  # request months kept for the snapshot
ORDER_BLOCK_MONTHS = 12          # one order lag = a 12-month block
EVENTS_START = "2024-01-01"      # channel counts: 5-day buckets from this day
EVENT_BUCKET_DAYS = 5
CHANNEL_EVENT_TYPES = {1: "click", 2: "view", 3: "purchase"}


def month_key(yyyymm: int) -> int:
    """0-based month number: year * 12 + (month - 1)."""
    return (yyyymm // 100) * 12 + yyyymm % 100 - 1


def key_start(key: int) -> dt.datetime:
    return dt.datetime(key // 12, key % 12 + 1, 1)


def month_start(yyyymm: int) -> dt.datetime:
    return key_start(month_key(yyyymm))


def next_month_start(yyyymm: int) -> dt.datetime:
    return key_start(month_key(yyyymm) + 1)


def _ts(d: dt.datetime) -> Column:
    """NTZ literal: the driver tables hold TIMESTAMP_NTZ, so no session time zone applies."""
    return ntz_literal(d.strftime("%Y-%m-%d %H:%M:%S"))


def _order_index(date_col: str, anchor: int) -> Column:
    """Months between the anchor month and the month of ``date_col``."""
    return F.lit(month_key(anchor)) - (F.year(date_col) * 12 + F.month(date_col) - 1)


def _in_lag(lag: Column, i: int) -> Column:
    return lag == F.lit(i)


def order_measures(t: Tables, anchor: int = ANCHOR_MONTH, outcome_start: str = OUTCOME_START) -> DataFrame:
    """Per client: balance per lag, status-F flag per lag, tenure, attrition."""
    o = (t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
         .withColumn("idx", _order_index("o_orderdate", anchor)))
    in_window = (F.col("idx") >= 0) & (F.col("idx") < N_LAGS * ORDER_BLOCK_MONTHS)
    lag = F.when(in_window, F.floor(F.col("idx") / ORDER_BLOCK_MONTHS))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    o = o.select("o_custkey", "o_orderstatus", "o_orderdate", "idx",
                 lag.alias("lag"), cents.alias("cents"))
    aggs = []
    for i in range(N_LAGS):
        aggs.append(F.sum(F.when(_in_lag(F.col("lag"), i), F.col("cents"))).alias(f"cents{i}"))
    for i in range(N_LAGS):
        aggs.append(F.max(F.when(_in_lag(F.col("lag"), i) & (F.col("o_orderstatus") == "F"), 1)
                          .otherwise(0)).cast("bigint").alias(f"FLG_SEGURO_MENOS{i}"))
    aggs.append(F.max(F.when(F.col("idx") >= 0, F.col("idx"))).alias("first_idx"))
    aggs.append(F.max(F.when(F.col("o_orderdate") >= _ts(dt.datetime.fromisoformat(outcome_start)), 1)
                      .otherwise(0)).alias("active_after"))
    g = o.groupBy(F.col("o_custkey").alias(ID)).agg(*aggs)
    # integer division keeps the balance exact for any sum size
    return g.select(ID, *[F.expr(f"cents{i} div 100").alias(f"SDO_ACTIVO_MENOS{i}") for i in range(N_LAGS)],
                    *[f"FLG_SEGURO_MENOS{i}" for i in range(N_LAGS)], "first_idx", "active_after")


def item_measures(t: Tables, anchor: int = ANCHOR_MONTH) -> DataFrame:
    """Per client: distinct suppliers per lag (null if none), returned-item flag per lag."""
    lo_key = month_key(anchor) - (N_LAGS * ORDER_BLOCK_MONTHS - 1)
    lo_day = key_start(lo_key)
    o = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
         .where((F.col("o_orderdate") >= _ts(lo_day))
                & (F.col("o_orderdate") < _ts(next_month_start(anchor))))
         .select("o_orderkey", "o_custkey",
                 F.floor(_order_index("o_orderdate", anchor) / ORDER_BLOCK_MONTHS).alias("lag")))
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag")
    joined = o.join(li, o.o_orderkey == li.l_orderkey)
    # Level 1: one row per (client, lag, supplier); partial aggregation map-side.
    per_supp = (joined.groupBy("o_custkey", "lag", "l_suppkey")
                .agg(F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("r")))
    aggs = []
    for i in range(N_LAGS):
        n = F.count(F.when(_in_lag(F.col("lag"), i), 1))
        aggs.append(F.when(n > 0, n).cast("bigint").alias(f"NRO_ENTID_SSFF_MENOS{i}"))
    for i in range(N_LAGS):
        aggs.append(F.max(F.when(_in_lag(F.col("lag"), i), F.col("r"))).cast("bigint")
                    .alias(f"FLG_SDO_OTSSFF_MENOS{i}"))
    return per_supp.groupBy(F.col("o_custkey").alias(ID)).agg(*aggs)


def event_measures(t: Tables) -> DataFrame:
    """Per client: count of click / view / purchase events per 5-day bucket, null if none."""
    start = dt.date.fromisoformat(EVENTS_START)
    days = F.datediff(F.to_date("ts"), F.lit(start))
    e = (t.events.select("user_id", "ts", "event_type")
         .where((F.col("ts") >= _ts(dt.datetime.combine(start, dt.time())))
                & (F.col("ts") < _ts(dt.datetime.combine(start + dt.timedelta(days=N_LAGS * EVENT_BUCKET_DAYS),
                                                         dt.time()))))
         .select("user_id", "event_type",
                 (F.lit(N_LAGS - 1) - F.floor(days / EVENT_BUCKET_DAYS)).alias("lag")))
    aggs = []
    for k, etype in CHANNEL_EVENT_TYPES.items():
        for i in range(N_LAGS):
            n = F.count(F.when(_in_lag(F.col("lag"), i) & (F.col("event_type") == etype), 1))
            aggs.append(F.when(n > 0, n).cast("bigint").alias(f"NRO_ACCES_CANAL{k}_MENOS{i}"))
    return e.groupBy(F.col("user_id").alias(ID)).agg(*aggs)


def clients(t: Tables, anchor: int = ANCHOR_MONTH) -> DataFrame:
    """The 53-column client snapshot for month ``anchor`` (with label)."""
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))
    nation = F.broadcast(t.nation.select("n_nationkey", "n_regionkey"))
    cust = (t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    k = F.col("c_custkey")
    base = cust.select(
        k.alias(ID),
        F.lit(anchor).cast("bigint").alias(MONTH),
        (k % 2).cast("bigint").alias("FLG_BANCARIZADO"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("RANG_INGRESO"),
        F.when(F.col("r_name").isin("AMERICA", "ASIA"), F.lit("Lima"))
         .when(F.col("r_name") != "AFRICA", F.lit("Provincia")).alias("FLAG_LIMA_PROVINCIA"),
        F.when(k % 11 != 0, (F.lit(18) + k % 60).cast("double")).alias("EDAD"),
        F.when(F.col("c_acctbal") < 0, F.lit("Cero"))
         .otherwise(F.concat(F.lit("Rango_SDO_0"),
                             (F.lit(1) + F.floor(F.col("c_acctbal") / 2500)).cast("string")))
         .alias("RANG_SDO_PASIVO_MENOS0"),
        F.concat(F.lit("Rango_productos_0"), (F.lit(1) + k % 4).cast("string"))
         .alias("RANG_NRO_PRODUCTOS_MENOS0"),
        F.when(k % 3 == 0, 1).otherwise(0).cast("bigint").alias("FLG_NOMINA"),
    )
    om = order_measures(t, anchor)
    im = item_measures(t, anchor)
    em = event_measures(t)
    j = base.join(om, ID, "left").join(im, ID, "left").join(em, ID, "left")
    derived = {
        "ANTIGUEDAD": F.floor(F.col("first_idx") / 12).cast("double"),
        "ATTRITION": F.when(F.col("active_after") == 1, 0).otherwise(1).cast("bigint"),
    }
    for i in range(N_LAGS):
        for m in ("FLG_SEGURO", "FLG_SDO_OTSSFF"):
            derived[f"{m}_MENOS{i}"] = F.coalesce(F.col(f"{m}_MENOS{i}"), F.lit(0).cast("bigint"))
    return j.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in CLIENT_COLUMNS])


def requests(t: Tables, month_range: tuple[int, int] = REQUEST_RANGE) -> DataFrame:
    """The long request log for an inclusive CODMES range.

    The month range becomes a pushed ``o_orderdate`` filter on the scan.
    """
    lo, hi = month_range
    o = (t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
         .where((F.col("o_orderdate") >= _ts(month_start(lo)))
                & (F.col("o_orderdate") < _ts(next_month_start(hi)))))
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag")
    p = t.part.select("p_partkey", "p_type")
    j = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        F.col("o_custkey").alias(ID),
        F.col("o_orderstatus").alias("TIPO_REQUERIMIENTO2"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("DICTAMEN"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias(MONTH),
        F.col("p_type").alias("PRODUCTO_SERVICIO_2"),
        F.col("o_orderpriority").alias("SUBMOTIVO_2"),
    )


def scored_clients(t: Tables) -> DataFrame:
    """Deterministic score for the evaluation operators: client id, label and y_prob.

    y_prob = ((round(acctbal*100) + 100000) div 11000) / 100: values 0.00..1.00
    with many ties, computed in integers so every engine agrees.
    """
    c = clients(t).select(ID, "ATTRITION")
    s = t.customer.select(
        F.col("c_custkey").alias(ID),
        (F.expr("(cast(round(c_acctbal * 100) AS BIGINT) + 100000) div 11000")
         / F.lit(100).cast("double")).alias("y_prob"))
    return c.join(s, ID)


__all__ = ["clients", "requests", "scored_clients", "order_measures", "item_measures",
           "event_measures", "lag_cols"]
