"""Label encoding with a stored long-form mapping (column, label, code).

Fit: distinct labels per column, sorted, coded 0..k-1; a null label, when
present, takes the last code k (the order a sorted vocabulary with the
missing value appended gives). Apply: a null-safe join on the label for
each encoded column, whatever the number of labels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from retenta.functions.scalar import map_values, replace_value
from retenta.operators.ordering import row_number_global

# Recoding done before label encoding.
ZERO_BALANCE_OLD, ZERO_BALANCE_NEW = "Cero", "Rango_SDO_00"
LIMA_MAP = {"Lima": 1, "Provincia": 0}


def recode(df: DataFrame) -> DataFrame:
    """'Cero' -> 'Rango_SDO_00' so zero sorts first; Lima/Provincia -> 1/0 (others null)."""
    exprs = []
    for c in df.columns:
        if c == "RANG_SDO_PASIVO_MENOS0":
            exprs.append(replace_value(c, ZERO_BALANCE_OLD, ZERO_BALANCE_NEW).alias(c))
        elif c == "FLAG_LIMA_PROVINCIA":
            exprs.append(map_values(c, LIMA_MAP).cast("bigint").alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and c not in exclude]


def fit_label_encoder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long table (column, label, code). Codes are the distributed row number
    of the distinct labels, so a column may have any number of them."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns
    ])).alias("e")).select("e.column", "e.label").distinct()
    ranked = row_number_global(stacked, [F.col("label").asc_nulls_last()], ["column"], name="place")
    return ranked.select("column", "label", (F.col("place") - 1).alias("code"))


def apply_label_encoder(df: DataFrame, encoder: DataFrame, columns: Sequence[str],
                        on_unseen: str = "error") -> DataFrame:
    """Replace each column by its code, by a join with the mapping (Spark
    broadcasts it if its size allows, and shuffles otherwise).

    ``on_unseen``: ``error`` fails the job on a label not seen at fit time,
    ``null`` gives null, ``keep`` gives one code past the last known one.
    """
    last = {}
    if on_unseen == "keep":
        last = {r["column"]: r["code"] for r in encoder.where(F.col("column").isin(list(columns)))
                .groupBy("column").agg(F.max("code").alias("code")).collect()}
    out = df
    for i, c in enumerate(columns):
        mine = encoder.where(F.col("column") == c).select(F.col("label").alias(f"__label_{i}"),
                                                          F.col("code").alias(f"__code_{i}"))
        out = out.join(mine, F.col(c).cast("string").eqNullSafe(F.col(f"__label_{i}")), "left")
    place = {c: i for i, c in enumerate(columns)}
    return out.select(*[_unseen(F.col(f"__code_{place[c]}"), c, on_unseen, last.get(c, -1)).alias(c) if c in place
                        else F.col(f"`{c}`") for c in df.columns])


def _unseen(code, c, on_unseen, last):
    if on_unseen == "null":
        return code
    if on_unseen == "keep":
        return F.coalesce(code, F.lit(last + 1).cast("bigint"))
    if on_unseen != "error":
        raise ValueError(on_unseen)
    return F.when(code.isNull(), F.raise_error(F.concat(F.lit(f"unseen label in {c}: "),
                                                        F.coalesce(F.col(c).cast("string"), F.lit("null")))))\
        .otherwise(code).cast("bigint")
