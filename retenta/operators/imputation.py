"""Imputation: fit mode / median on training rows, apply with coalesce.

The parameter table has the reference's shape (dataframe, variable,
strategy, value) with the value stored as text (the reference's CSV mixes
strings and numbers); apply casts it back to the column type.

Mode: most frequent non-null value, ties go to the smallest value. Median:
exact interpolated median of non-nulls. Both come from one table of counts
per (variable, value), summed before the shuffle: the mode is the value of
the largest count, the median the values at the two middle ranks of the
running count. No task holds the distinct values of a column, so the
columns may be of any cardinality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from retenta.operators.ordering import running_sums
from retenta.session import materialize

# The imputation plan of the reference.
CLIENT_IMPUTATION = (("RANG_INGRESO", "moda"), ("FLAG_LIMA_PROVINCIA", "moda"),
                     ("EDAD", "mediana"), ("ANTIGUEDAD", "mediana"))
REQUEST_IMPUTATION = (("DICTAMEN", "moda"),)


def _value_counts(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(variable, value, n) of the non-null values of each column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast(kind).alias("value"))
                                for c in columns])).alias("e")
    return (df.select(pairs).select("e.variable", "e.value").where(F.col("value").isNotNull())
            .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))


def fit_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value as text). Text and numbers tie to the smallest value of their own order."""
    kinds = dict(df.dtypes)
    parts = []
    for kind in sorted({kinds[c] for c in columns}):
        counts = _value_counts(df, [c for c in columns if kinds[c] == kind], kind)
        parts.append(counts.groupBy("variable").agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).cast("string").alias("value")))
    return _union(parts)


def fit_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value as text)."""
    counts = materialize(_value_counts(df, columns, "double"), "value-counts")
    totals = counts.groupBy("variable").agg(F.sum("n").alias("total"))
    ranked = running_sums(counts, ["n"], ["value"], ["variable"]).join(totals, "variable")
    at = lambda rank: F.min(F.when(F.col("n_cum") >= rank, F.col("value")))
    low, high = F.expr("(total + 1) div 2"), F.expr("total div 2 + 1")
    return ranked.groupBy("variable").agg(((at(low) + at(high)) / 2).cast("string").alias("value"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_table(df: DataFrame, table_name: str, plan: Sequence[tuple[str, str]]) -> DataFrame:
    """One parameter row per variable; the value is null if the column has none."""
    fitted = []
    for strategy, fit in (("moda", fit_modes), ("mediana", fit_medians)):
        columns = [c for c, s in plan if s == strategy]
        if columns:
            fitted.append(fit(df, columns))
    if unknown := {s for _, s in plan} - {"moda", "mediana"}:
        raise ValueError(f"unknown strategies {sorted(unknown)}")
    names = df.sparkSession.createDataFrame([(table_name, c, s) for c, s in plan],
                                            "dataframe string, variable string, strategy string")
    return names.join(F.broadcast(_union(fitted)), "variable", "left").select(
        "dataframe", "variable", "strategy", "value")  # a row per planned variable


def fit_imputation(clients: DataFrame, requests: DataFrame) -> DataFrame:
    return fit_table(clients, "clientes", CLIENT_IMPUTATION).unionByName(
        fit_table(requests, "requerimientos", REQUEST_IMPUTATION))


def imputation_values(params: DataFrame, table_name: str, variables: Sequence[str]) -> dict:
    """{variable: value} of one table. Each variable must have exactly one row."""
    rows = (params.where((F.col("dataframe") == table_name) & F.col("variable").isin(list(variables)))
            .groupBy("variable").agg(F.first("value").alias("value"), F.count(F.lit(1)).alias("n")).collect())
    bad = sorted(set(variables) - {r["variable"] for r in rows}) + sorted(r["variable"] for r in rows if r["n"] > 1)
    if bad:
        raise ValueError(f"imputation of {table_name}: no row, or several, for {bad}")
    return {r["variable"]: r["value"] for r in rows}


def apply_imputation(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls of the variables with their fitted values: typed literals in a narrow projection."""
    dtypes = dict(df.dtypes)
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c]).cast(dtypes[c])).alias(c) if c in values
                       else F.col(c) for c in df.columns])
