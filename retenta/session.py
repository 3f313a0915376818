"""Session helpers.

Library code never overrides what the cluster configured; ``get_session``
is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts from
# runtime sizes, splits skewed join partitions, and the session time zone is
# pinned so date formatting is reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "retenta") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is
    used as is; without it a cluster session raises. Only a local session
    (``local[...]``: one machine) gets a scratch folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            # each machine would write to its own disk and later reads would miss parts
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        # a core setting cannot change at runtime: set the context's folder instead
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retenta-ckpt-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for written intermediate tables: under the shared checkpoint
    folder, grouped by application so one run's tables expire together."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/retenta-{spark.sparkContext.applicationId}/{name}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A scratch path no earlier call has used: a later run never overwrites
    files that a lazy result still reads."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def drop_scratch(spark: SparkSession) -> None:
    """Drop the application's scratch tables and delete their folder. Call it
    when no lazy result reads them any more."""
    for t in [t.name for t in spark.catalog.listTables() if t.name.startswith("retenta_")]:
        spark.sql(f"DROP TABLE IF EXISTS `{t}`")
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df, name: str = "stage", partition_by: tuple[str, ...] = ()):
    """Cut lineage: write ``df`` as a Parquet table in the shared checkpoint
    folder and read it back. Computed once (unlike an eager RDD checkpoint,
    which runs the plan for the count and again for the write); a lost
    executor re-reads files instead of recomputing joins and shuffles.
    ``partition_by`` lays the table out by those columns so later filters on
    them prune whole folders."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def discard(*tables) -> None:
    """Delete the files of tables that ``materialize`` wrote. Call it once whatever reads them is
    itself written: the disk a job holds is then that of the tables still to be read."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize_bucketed(df, name: str, key: str, buckets: int | None = None,
                         partition_by: tuple[str, ...] = ()):
    """Like ``materialize`` but bucketed (and sorted) by ``key`` as a catalog
    table located in the shared checkpoint folder: later group-bys and joins
    on ``key`` between tables with the same bucket count read co-located
    data and need no shuffle."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag = uuid.uuid4().hex
    table = f"retenta_{name.replace('-', '_')}_{tag}"
    # by key first: each task then holds whole buckets and writes one file for each
    w = df.repartition(n, key).write.mode("overwrite").format("parquet").option("path", scratch_path(spark, f"{name}-{tag}"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.bucketBy(n, key).sortBy(key).saveAsTable(table)
    return spark.table(table)
