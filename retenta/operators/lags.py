"""Monthly lag layout: long monthly facts <-> wide ``<MEASURE>_MENOS<i>``
columns, and lag-based variation on the long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from retenta.functions.schema import ID, N_LAGS


def month_lag(date_col: str, anchor_yyyymm: int):
    """0 for the anchor month, 1 for the month before, ..."""
    key = (anchor_yyyymm // 100) * 12 + anchor_yyyymm % 100 - 1
    return F.lit(key) - (F.year(date_col) * 12 + F.month(date_col) - 1)


def lag_pivot(facts: DataFrame, id_col: str, lag_col: str, value_col: str, measure: str,
              n_lags: int = N_LAGS) -> DataFrame:
    """Wide table: one row per id, ``{measure}_MENOS{i}`` = sum of values at lag i (null if none).

    Declared pivot values avoid the extra distinct-values job, and the
    group-by is on the id only (partial aggregation map-side).
    """
    f = facts.where(F.col(lag_col).between(0, n_lags - 1))
    return f.groupBy(id_col).pivot(lag_col, list(range(n_lags))).agg(F.sum(value_col)) \
        .select(id_col, *[F.col(str(i)).alias(f"{measure}_MENOS{i}") for i in range(n_lags)])


def lag_unpivot(df: DataFrame, measures: Sequence[str], id_col: str = ID, n_lags: int = N_LAGS) -> DataFrame:
    """(id, measure, lag, value) from the wide lag columns."""
    cols = [f"{m}_MENOS{i}" for m in measures for i in range(n_lags)]
    long = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        id_col, cols, "variable", "value")
    return long.select(id_col, F.regexp_extract("variable", r"^(.*)_MENOS(\d+)$", 1).alias("measure"),
                       F.regexp_extract("variable", r"^(.*)_MENOS(\d+)$", 2).cast("int").alias("lag"), "value")


def lag_variation(long: DataFrame, id_col: str = ID) -> DataFrame:
    """Per (id, measure, lag): change versus the previous month and the 3-month
    moving average ending at that lag. Each window partition holds 6 rows."""
    w = Window.partitionBy(id_col, "measure").orderBy(F.col("lag").desc())
    return long.select(id_col, "measure", "lag", "value",
                       (F.col("value") - F.lag("value").over(w)).alias("mom_change"),
                       F.avg("value").over(w.rowsBetween(-2, 0)).alias("avg_3m"))
