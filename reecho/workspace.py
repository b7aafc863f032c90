"""Tables written to the cluster's shared folder between the stages of a job."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"


class Workspace:
    """A folder for stage results.

    Reading a written table back cuts lineage: a lost executor costs re-reading
    files, not redoing the text work, and later stages read only the columns
    they need.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, label: str = "run") -> "Workspace":
        """A fresh folder under ``spark.checkpoint.dir``."""
        return cls(spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(_nullable(frame.schema)).parquet(self.path(name))

    def drop(self) -> None:
        """Removes the folder with all its tables."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    # local[...] is one machine; local-cluster[...] has executors with folders of their own
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    folder = _local_folders.get(spark.sparkContext.applicationId)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        _local_folders[spark.sparkContext.applicationId] = folder
    return folder


_local_folders: dict[str, str] = {}


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
