"""Client-level train/test split, id set operations and fold assignment.

The split order is ``md5(seed || ':' || id)``: a deterministic pseudo-random
order that does not depend on partitioning (``randomSplit`` does) and that
any SQL engine reproduces. ``mode="exact"`` takes exactly ceil(frac * n) ids
for test through the distributed row number; ``mode="hash"`` keeps ids whose
hash bucket falls under the fraction: no ordering, a single narrow pass,
size exact only in expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.schema import ID, LABEL
from retenta.operators.ordering import row_number_global

HASH_BUCKETS = 10_000


def split_key(id_col: str = ID, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def ids_distinct(df: DataFrame, id_col: str = ID) -> DataFrame:
    return df.select(id_col).where(F.col(id_col).isNotNull()).distinct()


def ids_intersect(a: DataFrame, b: DataFrame, id_col: str = ID) -> DataFrame:
    return a.select(id_col).intersect(b.select(id_col))


def split_ids(ids: DataFrame, test_frac: float = 0.3, seed: int = 42, id_col: str = ID,
              mode: str = "exact") -> DataFrame:
    """(id, split) with split in {'train', 'test'}; ``ids`` must be distinct."""
    if mode == "hash":
        bucket = F.conv(F.substring(split_key(id_col, seed), 1, 8), 16, 10).cast("bigint") % HASH_BUCKETS
        return ids.select(id_col, F.when(bucket < int(round(test_frac * HASH_BUCKETS)), "test")
                          .otherwise("train").alias("split"))
    ranked = row_number_global(ids.select(id_col, split_key(id_col, seed).alias("__k")),
                               [F.col("__k"), F.col(id_col)], name="__rn", total_name="__n")
    # test size ceil(frac * n), in double arithmetic like the usual splitters
    n_test = F.ceil(F.lit(float(test_frac)) * F.col("__n").cast("double"))
    return ranked.select(id_col, F.when(F.col("__rn") <= n_test, "test").otherwise("train").alias("split"))


def keep_ids(df: DataFrame, ids: DataFrame, id_col: str = ID) -> DataFrame:
    """Rows whose id is in ``ids``: a semi join, never a literal IN list."""
    return df.join(ids.select(id_col), id_col, "left_semi")


def split_frames(df: DataFrame, splits: DataFrame, id_col: str = ID) -> tuple[DataFrame, DataFrame]:
    train = keep_ids(df, splits.where(F.col("split") == "train"), id_col)
    test = keep_ids(df, splits.where(F.col("split") == "test"), id_col)
    return train, test


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def kfold_assign(df: DataFrame, k: int = 3, label_col: str = LABEL, id_col: str = ID,
                 seed: int = 42) -> DataFrame:
    """Stratified folds: within each label, rows in md5 order are dealt to folds 0..k-1."""
    keyed = df.select("*", split_key(id_col, seed).alias("__k"))
    ranked = row_number_global(keyed, [F.col("__k"), F.col(id_col)], partition_cols=[label_col], name="__rn")
    return ranked.select(*df.columns, ((F.col("__rn") - 1) % k).cast("int").alias("fold"))
