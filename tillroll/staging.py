"""Where jobs put tables that they read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the session's `spark.checkpoint.dir`.

    That folder is shared by all executors and outlives any of them. Only a
    local session may do without the setting and gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tillroll-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """What lies in `folder`, on any filesystem that Spark reads; nothing if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def delete(spark: SparkSession, folder: str) -> None:
    """Removes a folder, if it is there, with all that is in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
