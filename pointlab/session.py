"""Session settings, and where a job may leave intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings for large scans, as the published runs have them. 256 MB input splits keep the
# number of tasks over many terabytes down, 128 MB shuffle partitions fit a task's memory several times,
# and adaptive execution merges small partitions and splits skewed ones at run time.
SCAN_AND_SHUFFLE = {
    "spark.sql.files.maxPartitionBytes": "268435456",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "134217728",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.driver.maxResultSize": "512m",
    # A task may hold this many folders open, so writing by split needs no sort of the rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.session.timeZone": "UTC",
}

# Settings to read and write s3a:// paths. Credentials are left to the connector's own
# chain of providers (settings, environment, machine); 100 MB parts fit large Parquet files.
OBJECT_STORE = {
    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    "spark.hadoop.fs.s3a.multipart.size": "104857600",
}

# What the metrics report needs to find in the log: plain text lines.
EVENT_LOG = {
    "spark.eventLog.enabled": "true",
    "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false",
}


def session_builder(app_name: str, *, cores: int | None = None, object_store: bool = False,
                    event_log_dir: str | None = None, extra: dict[str, str] | None = None) -> SparkSession.Builder:
    """Builder with the settings above; master, memory and executors stay with spark-submit.

    ``cores`` is the total over all executors. Shuffles then start with four partitions per core,
    which adaptive execution merges where they turn out small.
    """
    settings = dict(SCAN_AND_SHUFFLE)
    if cores:
        settings["spark.sql.shuffle.partitions"] = str(cores * 4)
    if object_store:
        settings.update(OBJECT_STORE)
    if event_log_dir:
        settings.update(EVENT_LOG)
        settings["spark.eventLog.dir"] = event_log_dir
    settings.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    In local mode, where one machine is all there is, an unset folder is one in the warehouse; a cluster has
    to name one, as the warehouse may be a folder of the driver's machine.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return root.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends, or earlier by ``remove``."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    files, target = _file_system(spark, path)
    files.deleteOnExit(target)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written to a scratch path."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder, which outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
