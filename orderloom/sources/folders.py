"""Where intermediate tables, checkpoints and sinks may be written."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session may go without: it gets a fresh folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderloom-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/orderloom/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path, for whatever store the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, without opening any file."""
    system, target = _file_system(spark, pattern)
    return [str(status.getPath()) for status in system.globStatus(target) or []]


def remove_folder(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)


def file_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return bool(system.exists(target))
