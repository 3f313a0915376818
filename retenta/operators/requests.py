"""Per-client request profile: counts, distinct counts and one-hot counts.

All parts share the client key, so they are computed in ONE hash aggregate
(one shuffle, map-side partial aggregation) instead of one group-by per part
followed by an outer concat.

Distinct counts default to ``size(collect_set(c))``: the sets hold category
values (bounded vocabularies), so partial aggregation keeps them small and no
``Expand`` multiplies the rows, which four ``countDistinct`` would do (one
copy of every row per distinct column). ``distinct="expand"`` selects the
``countDistinct`` plan for comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.schema import ID, REQ_PRODUCT, REQ_REASON, REQ_TYPE, REQ_VERDICT

# Output names of the request aggregates.
TOTAL = "total_requerimientos"
DISTINCT_OUTPUTS = (
    (REQ_TYPE, "nro_tipos_requerimiento"),
    (REQ_VERDICT, "nro_dictamenes"),
    (REQ_PRODUCT, "nro_productos_servicios"),
    (REQ_REASON, "nro_submotivos"),
)
PIVOT_PREFIXES = ((REQ_TYPE, "tipo"), (REQ_VERDICT, "dictamen"))


def learn_categories(reqs: DataFrame, columns: Sequence[str] = (REQ_TYPE, REQ_VERDICT)) -> DataFrame:
    """Category values seen at fit time, long form (column, value), nulls excluded."""
    parts = [reqs.where(F.col(c).isNotNull()).select(F.lit(c).alias("column"), F.col(c).alias("value"))
             for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def _distinct_count(c: str, mode: str) -> Column:
    if mode == "expand":
        return F.countDistinct(c)
    if mode == "approx":
        return F.approx_count_distinct(c)
    return F.size(F.collect_set(c))


def pivot_count_names(categories: dict[str, Sequence[str]]) -> list[str]:
    names = []
    for col, prefix in PIVOT_PREFIXES:
        for v in sorted(categories.get(col, ())):
            names.append(f"{prefix}_{v}")
    return names


def request_profile(reqs: DataFrame, id_col: str = ID,
                    categories: dict[str, Sequence[str]] | None = None,
                    distinct: str = "set") -> DataFrame:
    """One row per client: total, four distinct counts and (optionally) one-hot counts.

    ``categories`` maps TIPO/DICTAMEN to the values learned at fit time; a
    learned value absent from this data still gets its column (all zero),
    a value not learned gets none. Null client ids are dropped first.
    """
    aggs = [F.count(F.lit(1)).alias(TOTAL)]
    aggs += [_distinct_count(c, distinct).cast("bigint").alias(name) for c, name in DISTINCT_OUTPUTS]
    if categories:
        for col, prefix in PIVOT_PREFIXES:
            for v in sorted(categories.get(col, ())):
                aggs.append(F.sum(F.when(F.col(col) == F.lit(v), 1).otherwise(0)).cast("bigint")
                            .alias(f"{prefix}_{v}"))
    return reqs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*aggs)


MAX_ONE_HOT_VALUES = 10_000


def categories_dict(cat_table: DataFrame) -> dict[str, list[str]]:
    """Bring the learned vocabularies (a handful of values per column) to the
    driver: they define output column names, so they must be known when the
    plan is built. A vocabulary too large to become columns is an error, not
    a silent cut."""
    rows = cat_table.orderBy("column", "value").limit(MAX_ONE_HOT_VALUES + 1).collect()
    if len(rows) > MAX_ONE_HOT_VALUES:
        raise ValueError(f"more than {MAX_ONE_HOT_VALUES} one-hot values; use the distinct counts instead")
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["column"], []).append(r["value"])
    return out
