"""Data profiling: null shares, class balance, per-column statistics,
balanced class weights and pairwise correlations, each one aggregate pass
returned in long form."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F


def _long(row: DataFrame, names: Sequence[str], prefix: str, value: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"{prefix}{i}").alias(value))
                    for i, n in enumerate(names)])
    return row.select(F.inline(arr))


def null_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns or df.columns)
    row = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100).alias(f"n{i}") for i, c in enumerate(cols)])
    return _long(row, cols, "n", "null_pct")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # the window runs over one row per class
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def class_weight_balanced(df: DataFrame, label: str) -> DataFrame:
    """n_samples / (n_classes * n_class) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()
    return counts.select(label, (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Every row with its class's weight; a row without a label raises."""
    weights = class_weight_balanced(df, label).withColumnRenamed("weight", weight_col)
    missing = F.raise_error(F.lit(f"a row has no label ({label} is null)")).cast("double")
    return df.join(F.broadcast(weights), label, "left").withColumn(weight_col, F.coalesce(weight_col, missing))


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, nulls, min, max, mean, sample std per column; one aggregate pass."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.sum(x.isNull().cast("bigint")).alias(f"z{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}")]
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("count"), F.col(f"z{i}").alias("nulls"),
                             F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
                             F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
                    for i, c in enumerate(columns)])
    return row.select(F.inline(arr))


def profile_sketch(df: DataFrame, columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Approximate distinct count and quartiles (bounded-memory sketches) per column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.approx_count_distinct(x).alias(f"d{i}"),
                 F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}")]
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("approx_distinct"),
                             F.col(f"q{i}")[0].alias("p25"), F.col(f"q{i}")[1].alias("p50"),
                             F.col(f"q{i}")[2].alias("p75")) for i, c in enumerate(columns)])
    return row.select(F.inline(arr))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation for every pair a < b (list order), long form; a pair takes the rows where
    neither value is null. Null for a pair without rows or with a constant column.

    A task adds its rows to products of fixed size (columns x columns, of values less the column's
    mean, so that sums don't cancel); the pairs' sums are then added by one aggregate. Any number
    of columns is one pass after the means, and what travels doesn't grow with the rows.
    """
    names = list(columns)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    # one number a column
    means = [m or 0.0 for m in values.agg(*[F.avg(x) for x in values.columns]).first()]
    i, j = np.triu_indices(len(names), 1)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares, products = (np.zeros((len(means), len(means))) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            held = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            x = np.where(held > 0, x - means, 0.0)
            n += held.T @ held
            sums += x.T @ held
            squares += (x * x).T @ held
            products += x.T @ x
        sides = (i, j, n[i, j].astype(np.int64), sums[i, j], sums[j, i], squares[i, j], squares[j, i], products[i, j])
        yield pa.RecordBatch.from_arrays([pa.array(s) for s in sides], names=["i", "j", "n", "sa", "sb", "qa", "qb", "p"])

    parts = values.mapInArrow(summed, "i long, j long, n long, sa double, sb double, qa double, qb double, p double")
    pairs = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "p")])
    spread = lambda q, s: F.col("n") * F.col(q) - F.col(s) * F.col(s)
    # a spread this small beside its terms is rounding
    varies = lambda q, s: spread(q, s) > F.col("n") * F.col(q) * 1e-12
    corr = (F.col("n") * F.col("p") - F.col("sa") * F.col("sb")) / F.sqrt(spread("qa", "sa")) / F.sqrt(spread("qb", "sb"))
    name = lambda k: F.element_at(F.array(*[F.lit(c) for c in names]), (F.col(k) + 1).cast("int"))
    return pairs.select(name("i").alias("a"), name("j").alias("b"), F.when(varies("qa", "sa") & varies("qb", "sb"), corr).alias("corr"))


def profile_top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """Most frequent non-null values per column: (column, value, n, rank).

    Counts per (column, value) pre-aggregate map-side; ranking within a column
    goes through range partitions (a column with many distinct values is
    spread over many tasks), ties broken by the value.
    """
    from retenta.operators.ordering import row_number_global
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                                for c in columns])).alias("e")
    counts = (df.select(pairs).select("e.column", "e.value").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = row_number_global(counts, [F.col("n").desc(), F.col("value").asc()], partition_cols=["column"],
                               name="rank")
    return ranked.where(F.col("rank") <= k)
