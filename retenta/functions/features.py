"""The engineered lag features as a specification table.

Each feature is (name, kind, measure, lags). ``engineer`` turns the whole
table into one ``select`` so the plan stays flat (no ``withColumn`` chain)
and codegen eliminates the shared sub-expressions (the 0-2 and 3-5 means
feed the 3-month variation).

Sign convention: variation = most recent lag minus older lag (m0 - m5).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.scalar import row_mean_skipna, row_sum_skipna
from retenta.functions.schema import lag_cols


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str          # diff | mean | mean_diff | sum
    measure: str
    lags: tuple = ()


def _trend_family(measure: str) -> list[Feature]:
    return [
        Feature(f"VAR_{measure}_6M", "diff", measure, (0, 5)),
        Feature(f"PROM_{measure}_0M_2M", "mean", measure, (0, 1, 2)),
        Feature(f"PROM_{measure}_3M_5M", "mean", measure, (3, 4, 5)),
        Feature(f"VAR_{measure}_3M", "mean_diff", measure, ((0, 1, 2), (3, 4, 5))),
        Feature(f"PROM_{measure}_6M", "mean", measure, tuple(range(6))),
    ]


# The engineered features of the reference (27).
FEATURE_SPEC: tuple[Feature, ...] = tuple(
    _trend_family("SDO_ACTIVO")
    + [Feature("MESES_CON_SEGURO", "sum", "FLG_SEGURO", tuple(range(6)))]
    + _trend_family("NRO_ACCES_CANAL1")
    + _trend_family("NRO_ACCES_CANAL2")
    + _trend_family("NRO_ACCES_CANAL3")
    + _trend_family("NRO_ENTID_SSFF")
    + [Feature("MESES_CON_SALDO", "sum", "FLG_SDO_OTSSFF", tuple(range(6)))]
)

ENGINEERED = tuple(f.name for f in FEATURE_SPEC)


def feature_column(f: Feature) -> Column:
    if f.kind == "diff":
        a, b = lag_cols(f.measure, f.lags)
        return (F.col(a) - F.col(b)).cast("double")
    if f.kind == "mean":
        return row_mean_skipna(lag_cols(f.measure, f.lags))
    if f.kind == "mean_diff":
        first, second = f.lags
        return row_mean_skipna(lag_cols(f.measure, first)) - row_mean_skipna(lag_cols(f.measure, second))
    if f.kind == "sum":
        return row_sum_skipna(lag_cols(f.measure, f.lags)).cast("double")
    raise ValueError(f.kind)


def engineer(df: DataFrame, spec=FEATURE_SPEC) -> DataFrame:
    """Append every engineered feature in one projection."""
    return df.select("*", *[feature_column(f).alias(f.name) for f in spec])


def lag_array(measure: str) -> Column:
    """The six lags of a measure as one array column (m0 first)."""
    return F.array(*[F.col(c).cast("double") for c in lag_cols(measure)])
