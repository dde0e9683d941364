"""Side inputs whose size is checked before they are copied to every executor."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_ROWS = 4096


def small_rows(df: DataFrame, limit: int = SMALL_ROWS):
    """The rows as an Arrow table if there are at most ``limit`` of them, else ``None``.

    At most ``limit + 1`` rows reach the driver, whatever the size of ``df``.
    """
    head = df.limit(limit + 1).toArrow()
    return head if head.num_rows <= limit else None


def small_side(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast when proven small, else unchanged for a shuffled join.

    A small side is pinned as literal rows, so it is computed once and not again for the
    broadcast.
    """
    rows = small_rows(df, limit)
    if rows is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out over the cores when the input has fewer splits than there are cores.

    Meant for a small table or a file that cannot be split, in front of costly narrow
    steps. An input of many splits, as any large one is, is left where it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder all executors share (``spark.checkpoint.dir``).

    A session on one machine without that setting, as in tests, uses a temporary folder. On
    a cluster that would scatter the files over the executors' disks, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _on_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="narrascope-")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def _on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def pinned(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder, for results that are used several times."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned_next(df: DataFrame, name: str, before: str | None = None) -> tuple[DataFrame, str]:
    """``pinned`` for the rounds of a loop: the rows of this round and their folder. That of the
    round before, from which they were made, is deleted once they are written."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    if before is not None:
        release(df.sparkSession, before)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder under the shared folder whose rows are no longer needed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
