"""Shared intermediate tables, written once to the cluster's shared folder.

A written table survives the loss of any executor, ends the lineage, is read column by column, and gives
Spark its true size for later join choices.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a folder of the warehouse, which a
    cluster's executors share as well. On a cluster, a warehouse in the machine's own file system is an error.
    The session's settings stay as they are."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staging"
    if not spark.sparkContext.master.startswith("local") and _files(spark, folder)[1].getScheme() == "file":
        raise ValueError(f"set spark.checkpoint.dir to a folder all executors share: {folder} may be this machine's own")
    return folder


def _files(spark: SparkSession, folder: str) -> tuple[Any, Any]:
    """The path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


class Staging:
    """Writes tables under a folder of its own for one run."""

    def __init__(self, spark: SparkSession, parent: str | None = None):
        self.spark = spark
        self.folder = f"{parent or shared_folder(spark)}/muster-run-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as read back."""
        path = f"{self.folder}/{name}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete one table, or the whole folder of the run; nothing may read it afterwards."""
        path, files = _files(self.spark, f"{self.folder}/{name}".rstrip("/"))
        files.delete(path, True)
