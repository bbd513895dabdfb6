"""Staged tables for iterative work.

Loops must not drag an ever longer lineage along and must survive the loss of an
executor, so their state is written to a shared folder and read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints, or else a part of its warehouse."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get(_WAREHOUSE, None)
    if not warehouse:
        raise ValueError(f"set {_SETTING} or {_WAREHOUSE} to a folder all executors can reach")
    return f"{warehouse.rstrip('/')}/_staged"


# Narrow rows (a key and a flag) that may be sent to every executor: some 50 MB.
BROADCAST_ROWS = 500_000


def sized(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table of keys with the join hint that its counted size allows.

    Up to so many rows are broadcast, so that wide rows on the other side stay where they are;
    beyond that both sides are shuffled and the keys are hashed.
    """
    return F.broadcast(keys) if keys.count() <= rows else keys.hint("shuffle_hash")


class Stage:
    """A run's own sub-folder; every table written to it gets a fresh name."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
        self._written = 0

    def write(self, df: DataFrame) -> DataFrame:
        """Write the table and return a reader of it without lineage."""
        self._written += 1
        path = f"{self.folder}/{self._written:04d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the run's tables; only for steps whose result no longer reads them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
