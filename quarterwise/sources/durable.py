"""How intermediate frames are laid out and kept."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names. Only a session in one process may do without: it gets a scratch folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get(SETTING, None)
    if not shared:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"Set {SETTING} to a folder that all executors share.")
        shared = tempfile.mkdtemp(prefix="checkpoint-")
    sc.setCheckpointDir(shared)


def durable(df: DataFrame) -> DataFrame:
    """Write the frame once to the checkpoint folder and continue from there.

    The files go with the frame where spark.cleaner.referenceTracking.cleanCheckpoints is on.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged_table(df: DataFrame, *by: str) -> DataFrame:
    """As `durable`, but a Parquet table partitioned by columns, so that a reader of one value opens its files only."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/staged-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.parquet(path)


def dealt_by(df: DataFrame, *keys: str, parallelism: int | None = None) -> DataFrame:
    """Hash-partition for work that is heavy per row rather than per byte.

    Adaptive execution would merge small partitions by their bytes and leave the work to a
    few tasks; an explicit count keeps the given, or else the configured, parallelism.
    """
    count = parallelism or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *keys)
