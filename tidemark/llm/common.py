"""What the text-corpus operators share: table loading, staging in the shared folder, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.staging import checkpoint_folder as shared_dir
from tidemark.staging import pinned, unpin

__all__ = ["arrow_map", "components", "drop_staged", "only", "pinned", "shared_dir", "staged", "table", "unpin", "unused"]

#: Set for Python workers: where this package is, one heap per process, large arrays returned to the system when freed.
_WORKER = {
    "PYTHONPATH": str(Path(__file__).resolve().parents[2]),
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": "4194304",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}
ARROW_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(names: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no column has that name."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with workers that find this package where the driver has it, and give freed memory back.

    A cluster gets the package by --py-files. Batches hold at most ``ARROW_ROWS`` rows: texts may be long.
    """
    spark = df.sparkSession
    spark.sparkContext.environment.update(_WORKER)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            _trim()

    return df.mapInArrow(run, schema)


def _trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


_HELD: dict[str, object] = {}


def only(name: str, clear=None) -> None:
    """In a Python worker, which Spark uses again: what other operators remember there is dropped and its pages freed."""
    others = [n for n in _HELD if n != name]
    for n in others:
        _HELD.pop(n)()
    if clear is not None:
        _HELD[name] = clear
    if others:
        _trim()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a staged table that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    roots = {f.rpartition("/")[0] for f in df.inputFiles()}
    for root in roots:
        if "/tidemark/" in root:
            path = jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` of long ids: one row (id, comp) per node that has an edge.

    ``comp`` is the smallest id reachable. Each round takes the least label among a node and its neighbours, then jumps to
    the label of that label; both are joins and partially aggregated minima, so a hub is never gathered in one task. Rounds
    are staged in the shared folder; nothing but a changed-row count reaches the driver.
    """
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    both = staged(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("comp")), "labels")
    for _ in range(max_rounds):
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("comp").alias("near"))
        )
        least = labels.join(near, "id", "left").select("id", "comp", F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("comp").alias("far"))
        new = least.join(jump, "low", "left").select("id", F.least("low", "far").alias("comp"), (F.least("low", "far") < F.col("comp")).alias("moved"))
        new = staged(new, "labels")
        moved = new.where("moved").limit(1).count()
        drop_staged(labels)
        labels = new
        if not moved:
            break
    else:
        raise RuntimeError("components did not settle")
    drop_staged(both)
    return labels.select("id", "comp")
