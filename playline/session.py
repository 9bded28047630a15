"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Event times are UTC; text without a zone is read as UTC too.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join partitions even where the next step then needs a shuffle of its own.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Many folders are listed by at most so many tasks; by default, each by a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}

#: Whether a query's shuffle files are removed as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "playline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="playline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/playline/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost
    executors, and leaves columnar files that later steps can prune. The shuffle files of the write
    go with it; by default they stay until the driver's JVM happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
