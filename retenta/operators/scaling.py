"""Standardisation with the POPULATION standard deviation.

``pyspark.ml.feature.StandardScaler`` divides by the sample deviation, so
the moments are computed here: mean and ``stddev_pop`` of all features,
stored long (feature, mean, std). A zero deviation scales by 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from retenta.functions.schema import ID, LABEL, MONTH

NOT_SCALED = (ID, MONTH, LABEL)
# Features per aggregate: the generated code of one aggregate stays small, and
# each block's scan reads its own columns only.
BLOCK = 16


def feature_columns(columns: Sequence[str], excluded: Sequence[str] = NOT_SCALED) -> list[str]:
    """Set difference of names in code-point order (upper case before lower case)."""
    return sorted(set(columns) - set(excluded))


def fit_standardizer(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean, std): plain aggregates over blocks of columns, so a row
    is never expanded; each partition ships one row per block."""
    out = None
    for at in range(0, len(features), BLOCK):
        block = features[at:at + BLOCK]
        x = [F.col(f"`{f}`").cast("double") for f in block]
        row = df.agg(*[F.struct(F.lit(f).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(f"f{i}")
                       for i, (f, c) in enumerate(zip(block, x))])
        long = row.select(F.inline(F.array(*[f"f{i}" for i in range(len(block))])))
        out = long if out is None else out.unionByName(long)
    return out


def moment_values(moments: DataFrame, features: Sequence[str]) -> dict:
    """{feature: (mean, std)}: exactly one row for each feature, none without a moment."""
    rows = moments.where(F.col("feature").isin(list(features))).groupBy("feature").agg(
        F.first("mean").alias("mean"), F.first("std").alias("std"), F.count(F.lit(1)).alias("n")).collect()
    got = {r["feature"]: (r["mean"], r["std"]) for r in rows if r["n"] == 1}
    bad = [f for f in features if None in got.get(f, (None,))]
    if bad:
        raise ValueError(f"no moments, or several, for {bad}")
    return got


def apply_standardizer(df: DataFrame, moments: DataFrame, features: Sequence[str],
                       keep: Sequence[str] = NOT_SCALED) -> DataFrame:
    """(x - mean) / std per feature; columns in ``keep`` come first, then features in order.

    The moments are two numbers per feature (a size fixed by the feature
    list), so they are read once and become literals: scaling is a narrow
    projection with no join.
    """
    values = moment_values(moments, features)
    out = [F.col(c) for c in keep if c in df.columns]
    for f in features:
        mean, std = values[f]
        out.append(((F.col(f"`{f}`").cast("double") - F.lit(mean)) / F.lit(1.0 if std == 0 else std)).alias(f))
    return df.select(*out)
