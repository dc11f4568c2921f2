"""Session helpers: one place that knows how a tidewrack job talks to Spark.

Library code never creates a session on its own; it takes the caller's.
``get_spark`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "tidewrack", shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small shuffle outputs stay spread over the cores (text work is CPU-bound);
        # at cluster scale partitions are far larger than this and it has no effect.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and simply read back. Only when it is
    unset (local tests, the bench) do we pick a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # Staged tables must be readable by every executor: never a machine-local folder.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tidewrack-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewrack-{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared checkpoint folder
    and reading it back.

    Used where a plan would otherwise read its input twice, or where ids derived from
    partition layout must stay stable if an executor is lost and tasks are re-run. One
    write job computes ``df`` once (``Dataset.checkpoint`` would compute it twice:
    once to count, once to save), and later reads get column pruning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return spread(df.sparkSession.read.parquet(path))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int | None = None):
    """Python tasks started inside get at most ``rows`` rows, and about ``size`` bytes, at
    once: texts are wide, and a batch is held by the executor, outside its heap, and by its
    worker."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    limits = {key: str(value) for key, value in limits.items() if value}
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy column work at least one partition per core.

    A scan of many files already has more splits than cores and is returned as is (no
    shuffle). Only a scan with fewer splits than ``defaultParallelism`` (e.g. one
    parquet row group) is spread round-robin; column pruning and filters still reach the
    scan below the repartition."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
