"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on; cluster size and memory are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # So many values of an IN filter reach the scan of the registry.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Listing many single files: one task for each is too many.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # Binary rows are large: bound Arrow batches by rows as well as bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


# While messages are read: files are small and many, so a task reads hundreds of them, not four.
SMALL_FILES = {
    "spark.sql.files.openCostInBytes": "65536",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": SETTINGS["spark.sql.sources.parallelPartitionDiscovery.parallelism"],
}


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """`SMALL_FILES` in this session until the end of the block."""
    before = {key: spark.conf.get(key, None) for key in SMALL_FILES}
    try:
        for key, value in SMALL_FILES.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession) -> str:
    """The folder shared by all executors; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="mailloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage at a checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_folder(spark))
    return df.checkpoint(eager=True)


def shared_uri(spark: SparkSession, folder: str) -> str:
    """A folder as an absolute URI; one without a scheme is on the cluster's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def arrow_store(uri: str):
    """Arrow's file system of an absolute URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
