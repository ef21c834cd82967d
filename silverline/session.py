"""Session construction and the few runtime settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the call site of every column expression doubles the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "silverline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; `settings` use `__` for dots in option names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # The context appends a folder of its own to the directory it was given.
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(made)
    return made


def ensure_checkpointing(spark: SparkSession) -> None:
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whichever file system the path names."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system the path names."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)
