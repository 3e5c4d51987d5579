"""Lineage cuts that survive the loss of executors.

Iterative operators write each round as Parquet under the shared folder that the
cluster names in ``spark.checkpoint.dir`` and read it back; the folder of an
earlier round is removed as soon as no later plan reads it. Where the setting is
absent a folder of this machine is used with a local master alone, as in tests; on a
cluster that is an error, since executors could not read each other's files.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; with a local master a temporary one of this machine where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="quireflow-")
    return _LOCAL[app]


class Scratch:
    """Written tables of one run of an operator, under a folder of its own.

    ``put`` writes a frame and returns its read-back, ``drop`` removes one table.
    Tables that the returned result still reads must stay; they go with the
    checkpoint folder of the application.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        schema = df.schema
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def _fs(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def exists(self, name: str) -> bool:
        fs, path = self._fs(name)
        return fs.exists(path)

    def drop(self, name: str) -> None:
        fs, path = self._fs(name)
        fs.delete(path, True)

    def release(self) -> None:
        """Let the driver forget plans of earlier rounds, so that executors delete their shuffle files."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
