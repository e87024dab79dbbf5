"""Where jobs keep checkpoints and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder that goes with the process; a cluster has to name one,
    since no other machine would see a folder of the driver's.
    """
    folder = spark.sparkContext.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.TemporaryDirectory(prefix="alertflow-", ignore_cleanup_errors=True)
    return _local_folders[application].name


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by ``new_folder`` that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
