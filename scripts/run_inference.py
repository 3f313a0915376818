"""Batch inference job (spark-submit entry point).

usage: spark-submit scripts/run_inference.py --train-out PATH --table-path PATH --month YYYYMM --run-ts TS
         (--clients PARQUET --requests PARQUET | --driver-tables DIR) [--model NAME] [--table NAME]
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from retenta.plans.batch import inference_job  # noqa: E402
from retenta.session import ensure_checkpoint_dir  # noqa: E402
from retenta.sources import standins  # noqa: E402
from retenta.sources.tables import Tables  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--train-out", required=True)
    ap.add_argument("--table-path", required=True)
    ap.add_argument("--month", type=int, required=True)
    ap.add_argument("--run-ts", required=True, help="UTC run time, yyyy-MM-dd HH:mm:ss")
    ap.add_argument("--model", help="default: the champion written by the training job")
    ap.add_argument("--table")
    ap.add_argument("--request-months", type=int, nargs=2, help="first and last request month")
    ap.add_argument("--on-unseen", default="error", choices=("error", "null", "keep"))
    ap.add_argument("--clients")
    ap.add_argument("--requests")
    ap.add_argument("--driver-tables")
    a = ap.parse_args()
    spark = SparkSession.builder.appName("retenta-inference").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.driver_tables:
        t = Tables(spark, a.driver_tables)
        clients, requests = standins.clients(t).drop("ATTRITION"), standins.requests(t)
    else:
        clients, requests = spark.read.parquet(a.clients), spark.read.parquet(a.requests)
    champion = spark.read.parquet(f"{a.train_out}/champion").first()
    if not a.model and not champion["accepted"]:
        raise SystemExit(f"{champion['champion']} was rejected by the quality gate")
    out = inference_job(spark, clients, requests, a.train_out, a.model or champion["champion"], a.month, a.run_ts,
                        a.table_path, a.table, tuple(a.request_months) if a.request_months else None, a.on_unseen)
    print(out.count(), "scored rows")


if __name__ == "__main__":
    main()
