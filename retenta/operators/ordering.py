"""Global order without one-task windows.

``row_number() OVER (ORDER BY ...)`` and a running sum over a global order
move every row into a single task. The functions here give the same values
with the work spread over range partitions:

1. ``repartitionByRange`` on (partition cols, order cols) and sort within
   each range partition;
2. tag rows with their range partition id and their position inside it
   (``monotonically_increasing_id`` after the sort is exactly that);
3. cut lineage by writing the tagged rows as a Parquet table in the shared
   checkpoint folder, so the sampled range bounds are fixed and a lost
   executor re-reads files instead of re-sampling;
4. per range partition (and group), count rows / sum values: one small row
   per partition;
5. prefix-sum those small rows to offsets and join them back by range partition
   (and group); Spark picks the join by the sizes it sees.

A group that holds a third of all rows is spread over many range partitions,
so no task sees more than one range partition of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from retenta.session import ensure_checkpoint_dir, materialize

_LOCAL_MASK = (1 << 33) - 1


def _sort_cols(order_cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_cols]


def _range_sorted(df: DataFrame, keys: list[Column], num_partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # the cluster sizes spark.sql.shuffle.partitions for its data; an explicit
    # count keeps the range write parallel even when AQE would merge ranges
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = ranged.select("*", F.spark_partition_id().alias("__pid"),
                           F.monotonically_increasing_id().alias("__mono"))
    return materialize(tagged, "range-sorted")


def row_number_global(df: DataFrame, order_cols: Sequence[Column | str],
                      partition_cols: Sequence[str] = (), name: str = "row_number",
                      num_partitions: int | None = None, total_name: str | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition_cols ORDER BY order_cols)``, 1-based.
    With ``total_name`` the group size (``count(*) OVER (PARTITION BY ...)``)
    is added too, taken from the same small offsets table."""
    pcols = list(partition_cols)
    keys = [F.col(c) for c in pcols] + _sort_cols(order_cols)
    t = _range_sorted(df, keys, num_partitions)
    local = F.col("__mono").bitwiseAND(F.lit(_LOCAL_MASK))
    counts = t.groupBy("__pid", *pcols).agg(F.count(F.lit(1)).alias("__n"), F.min(local).alias("__first"))
    w = Window.partitionBy(*pcols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__pid").alias("__opid"), *[F.col(c).alias(f"__g_{c}") for c in pcols],
                            "__first", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"),
                            F.sum("__n").over(Window.partitionBy(*pcols)).alias("__total"))
    cond = [F.col("__pid") == F.col("__opid")] + [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in pcols]
    joined = t.join(offsets, cond)
    rn = (F.col("__off") + local - F.col("__first") + 1).cast("bigint")
    extra = [F.col("__total").cast("bigint").alias(total_name)] if total_name else []
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], rn.alias(name), *extra)


def running_sums(df: DataFrame, value_cols: Sequence[str], order_cols: Sequence[Column | str],
                 partition_cols: Sequence[str] = (), suffix: str = "_cum",
                 num_partitions: int | None = None) -> DataFrame:
    """``sum(v) OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED PRECEDING)`` per value column.

    ``df`` should already be aggregated to one row per distinct order key
    (as the ROC code does), so rows with equal keys never straddle partitions
    in a way that matters: the sums are over rows, exactly like ROWS framing.
    """
    pcols = list(partition_cols)
    keys = [F.col(c) for c in pcols] + _sort_cols(order_cols)
    t = _range_sorted(df, keys, num_partitions)
    totals = t.groupBy("__pid", *pcols).agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    w = Window.partitionBy(*pcols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__pid").alias("__opid"), *[F.col(c).alias(f"__g_{c}") for c in pcols], *[
        F.coalesce(F.sum(f"__t_{v}").over(w), F.lit(0)).alias(f"__o_{v}") for v in value_cols])
    # running sum inside each range partition: every window partition is one
    # range partition (bounded by the range size), ordered by its local position
    lw = Window.partitionBy("__pid", *pcols).orderBy("__mono").rowsBetween(Window.unboundedPreceding, 0)
    local = t.select("*", *[F.sum(v).over(lw).alias(f"__l_{v}") for v in value_cols])
    cond = [F.col("__pid") == F.col("__opid")] + [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in pcols]
    joined = local.join(offsets, cond)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         *[(F.col(f"__o_{v}") + F.col(f"__l_{v}")).alias(f"{v}{suffix}") for v in value_cols])
