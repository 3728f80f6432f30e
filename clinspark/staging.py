"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage, survives the loss of executors, is computed once although several
joins read it, and has a known size before the next join is planned: a small side is then broadcast
from the start, and a large table is not shuffled only to find that out.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: What operators accept to store an intermediate result; ``lazily`` stores nothing.
Stage = Callable[[DataFrame], DataFrame]


def lazily(df: DataFrame) -> DataFrame:
    return df


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's checkpoint setting.

    Only a local-mode session without the setting gets a folder of its own; there the driver and
    the executors are the same process.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="clinspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Staging:
    """One run's folder of intermediate tables; an instance is itself a ``Stage``."""

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/clinspark-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """Write ``df`` and read it back as a plain table scan."""
        target = self.path(name or f"stage-{uuid.uuid4().hex}")
        df.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    __call__ = table

    def side(self, stored: DataFrame, row_bytes: int = 64) -> DataFrame:
        """A stored table as a side of a join; it is merged if its rows, hashed on the driver, are over the broadcast threshold.

        Spark holds the threshold against the files, which may be a tenth of that. ``row_bytes`` is what a hashed row takes,
        64 for a few numbers.
        """
        most = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return stored.hint("merge") if stored.count() * row_bytes > most else stored

    def remove(self) -> None:
        """Delete this run's own folder; tables read from it are gone with it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
