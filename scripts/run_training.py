"""Batch training job (spark-submit entry point).

usage: spark-submit scripts/run_training.py --out PATH
         (--clients PARQUET --requests PARQUET | --driver-tables DIR)
         [--grids quick|small|full] [--metric recall|auc|f1] [--split-mode exact|hash]
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from retenta.plans.batch import training_job  # noqa: E402
from retenta.session import ensure_checkpoint_dir  # noqa: E402
from retenta.sources import standins  # noqa: E402
from retenta.sources.tables import Tables  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--out", required=True)
    ap.add_argument("--clients")
    ap.add_argument("--requests")
    ap.add_argument("--driver-tables")
    ap.add_argument("--grids", default="small")
    ap.add_argument("--month", type=int, help="client month yyyymm; default: all rows given")
    ap.add_argument("--request-months", type=int, nargs=2, help="first and last request month")
    ap.add_argument("--join-how", default="left", choices=("left", "inner"))
    ap.add_argument("--one-hot", action="store_true")
    ap.add_argument("--metric", default="recall")
    ap.add_argument("--split-mode", default="exact")
    a = ap.parse_args()
    spark = SparkSession.builder.appName("retenta-training").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.driver_tables:
        t = Tables(spark, a.driver_tables)
        clients, requests = standins.clients(t), standins.requests(t)
    else:
        clients, requests = spark.read.parquet(a.clients), spark.read.parquet(a.requests)
    # raises, after the metrics are written, if the champion misses the quality gate
    res = training_job(spark, clients, requests, a.out, grids=a.grids, metric=a.metric, split_mode=a.split_mode,
                       month=a.month, request_months=tuple(a.request_months) if a.request_months else None,
                       join_how=a.join_how, with_pivot_counts=a.one_hot)
    res.champion.show(truncate=False)


if __name__ == "__main__":
    main()
