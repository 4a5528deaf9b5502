"""Session set-up and the helpers that depend on where Spark runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "amperline", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session; cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the time zone every hour, date and freshness value depends on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a local one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            shared = tempfile.mkdtemp(prefix="amperline-")
        context.setCheckpointDir(shared)
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new, unused folder for tables that live as long as a job."""
    return f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(frame: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Several later steps then see identical values, also after an executor is
    lost, and nothing upstream runs twice. The stored size is known to Catalyst,
    so joins with the table are broadcast only below the configured threshold.
    The shuffle files of the write go with it: the table takes their place.
    ``folder`` names the place (from ``scratch_folder``) for a later ``discard``.
    """
    spark = frame.sparkSession
    path = folder or scratch_folder(spark)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete scratch tables of which all that is still needed has been written elsewhere."""
    shared = shared_folder(spark)
    for folder in folders:
        if not folder.startswith(f"{shared}/table-"):
            raise ValueError(f"not a scratch table: {folder}")
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
