"""Session construction and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "evidentia", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings every plan here relies on (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def spread(spark: SparkSession) -> int:
    """Partitions for rows that take far more work than their size tells: a given number is not merged into fewer."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="evidentia-")
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through the reliable checkpoint folder.

    The folder is the cluster's ``spark.checkpoint.dir``. Only a local master
    with no folder configured (tests) gets a throw-away one; a cluster without
    a shared folder is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if configured:
            context.setCheckpointDir(configured)
        elif context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="evidentia-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return df.checkpoint(eager=True)

