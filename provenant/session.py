"""Session helpers: a local default session, and where shared scratch data goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "provenant", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", conf.pop("shuffle_partitions", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "6g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir``, as the cluster's file systems resolve it.

    A path without a scheme belongs to the default file system. Where the setting is absent, a local session (tests, a
    laptop) gets a fresh temporary folder; on a cluster that is an error, as executors share no such folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        java = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = java.get() if java.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="provenant-")
        spark.sparkContext.setCheckpointDir(found)
    return qualified(spark, found)


def qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application inside :func:`checkpoint_dir`; it is deleted when the driver's JVM ends, also after a failure."""
    found = f"{checkpoint_dir(spark)}/provenant-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(found)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return found


def written(spark: SparkSession, rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` as a table in ``path``, or in :func:`run_dir`, read again: later plans share it and a lost executor costs a re-read."""
    path = path or f"{run_dir(spark)}/{uuid.uuid4().hex}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
