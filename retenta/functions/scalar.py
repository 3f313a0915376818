"""Scalar column functions with the null semantics of the reference.

All of these return Spark ``Column`` expressions so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ColumnLike = Column | str

# Risk band cut points and labels.
HIGH_RISK_CUT = 0.415
MEDIUM_RISK_CUT = 0.285
HIGH_RISK, MEDIUM_RISK, LOW_RISK = "High risk", "Medium risk", "Low risk"


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast_numeric(c: ColumnLike, to: str) -> Column:
    """Safe cast: text that does not parse becomes null (``'1.5'`` to BIGINT is null)."""
    return _c(c).try_cast(to)


def typed_projection(df: DataFrame, bigint_cols: Sequence[str], double_cols: Sequence[str],
                     keep: Sequence[str] = (), order: Sequence[str] | None = None) -> DataFrame:
    """Project with safe casts; columns in ``keep`` pass through untouched."""
    exprs = {}
    for c in bigint_cols:
        exprs[c] = try_cast_numeric(c, "bigint").alias(c)
    for c in double_cols:
        exprs[c] = try_cast_numeric(c, "double").alias(c)
    for c in keep:
        exprs[c] = F.col(c)
    names = list(order) if order is not None else list(exprs)
    return df.select(*[exprs[n] for n in names if n in exprs])


def rename_upper(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def empty_to_null(c: ColumnLike) -> Column:
    """Exactly ``''`` becomes null (no trimming)."""
    return F.nullif(_c(c), F.lit(""))


def nan_to_null(c: ColumnLike) -> Column:
    """The no-NaN rule: floating NaN is turned into null at the readers."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def fill_with_value(c: ColumnLike, value) -> Column:
    return F.coalesce(_c(c), value if isinstance(value, Column) else F.lit(value))


def replace_value(c: ColumnLike, old, new) -> Column:
    col = _c(c)
    return F.when(col == F.lit(old), F.lit(new)).otherwise(col)


def map_values(c: ColumnLike, mapping: Mapping) -> Column:
    """Map values through ``mapping``; values not in it become null."""
    col = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr


def _plus(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def row_sum_skipna(cols: Sequence[ColumnLike]) -> Column:
    """Sum across columns ignoring nulls; all null gives 0."""
    return _plus([F.coalesce(_c(c), F.lit(0)) for c in cols])


def row_count_notnull(cols: Sequence[ColumnLike]) -> Column:
    return _plus([_c(c).isNotNull().cast("int") for c in cols])


def row_mean_skipna(cols: Sequence[ColumnLike]) -> Column:
    """Mean across columns ignoring nulls; all null gives null.

    Summed left to right in the column order, so every engine adds in the
    same order.
    """
    return (row_sum_skipna(cols).cast("double")
            / F.nullif(row_count_notnull(cols), F.lit(0)).cast("double"))


def risk_band(p: ColumnLike, high: float = HIGH_RISK_CUT, medium: float = MEDIUM_RISK_CUT) -> Column:
    """High at or above ``high``, Medium at or above ``medium``, Low otherwise (null too)."""
    col = _c(p)
    return (F.when(col >= F.lit(high), F.lit(HIGH_RISK))
            .when(col >= F.lit(medium), F.lit(MEDIUM_RISK))
            .otherwise(F.lit(LOW_RISK)))


def threshold_label(p: ColumnLike, t) -> Column:
    return (_c(p) >= (t if isinstance(t, Column) else F.lit(t))).cast("int")


def ntz_literal(value: str) -> Column:
    """A TIMESTAMP_NTZ literal: compares with NTZ columns without any session time zone."""
    return F.to_timestamp_ntz(F.lit(value))


def instant_from_utc(ntz: ColumnLike, spark) -> Column:
    """TIMESTAMP instant of a UTC wall-clock TIMESTAMP_NTZ, whatever the session time zone."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ntz)).cast("timestamp")


def utc_wall_clock(instant: ColumnLike) -> Column:
    """TIMESTAMP_NTZ wall clock in UTC of a TIMESTAMP instant."""
    return F.convert_timezone(None, F.lit("UTC"), _c(instant))


def load_date(ts: ColumnLike, tz: str = "America/Lima", source_tz: str = "UTC") -> Column:
    """``yyyyMMdd`` in time zone ``tz`` of a TIMESTAMP_NTZ wall clock in ``source_tz``;
    independent of the session time zone."""
    return F.date_format(F.convert_timezone(F.lit(source_tz), F.lit(tz), _c(ts).cast("timestamp_ntz")), "yyyyMMdd")


def coef_variation(std: ColumnLike, mean: ColumnLike) -> Column:
    return F.try_divide(_c(std), _c(mean))
