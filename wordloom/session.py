"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wordloom", memory: str | None = None) -> SparkSession:
    """A session with the settings the operators rely on.

    AQE coalesces small shuffle partitions, turns joins into broadcast joins once the
    run-time size of a side is known to be small, and splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster in ``spark.checkpoint.dir``.

    A local session that names none gets a temporary one; on a cluster that is an error, as
    every executor would write to its own disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wordloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one; runs never see each other's files."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    The work behind it is done once, and what follows starts from files, also after an
    executor is lost.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
