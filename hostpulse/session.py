"""Session settings and the folder that jobs may write their intermediate data to."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window state lives on disk and goes to the checkpoint as change logs, not as heap maps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(name: str = "hostpulse", **extra: str) -> SparkSession:
    """A session with the settings above. Cluster size, memory and shuffle width come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new path under `spark.checkpoint.dir`, the folder that every executor can reach, gone when the driver ends.

    Only a local session without that setting gets a temporary folder. On a cluster such a folder
    would be on one machine and its data would be gone with it, so there the setting is required.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hostpulse-"))
        base = context.getCheckpointDir()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _remove_at_end(spark, path)
    return path


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """The file system drops the folder when the driver ends; until then results may still be read from it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Drops a folder of `shared_dir` as soon as its caller needs it no longer."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
