"""Rows computed once into the folder that all executors share, so that a plan may read them twice and outlive an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset on a local master, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{_OWN[context.applicationId]}"


def pinned(df: DataFrame) -> DataFrame:
    """``df`` in reliable checkpoint files, in the order and partitions it was computed in.

    The files go by ``unpin``; else, where spark.cleaner.referenceTracking.cleanCheckpoints is set, when the frame does.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    return df.checkpoint()


def unpin(*frames: DataFrame) -> None:
    """Removes the files of pinned frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
