"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

#: Folders written within each open ``scratch``, innermost last.
_OPEN: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a single machine gets a temporary one and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="loomery-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to a fresh table of the shared folder and read it back.

    This cuts lineage: a lost executor costs the tasks that read the table, not
    the work that led to it. An empty frame gives an empty table. ``keep``: the table outlives ``scratch``.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/loomery-{uuid.uuid4().hex}"
    if _OPEN and not keep:
        _OPEN[-1].append(folder)
    df.write.parquet(f"{folder}/{label}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{label}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written within are deleted at the end, but those to keep."""
    _OPEN.append([])
    try:
        yield
    finally:
        remove(spark, _OPEN.pop())


def remove(spark: SparkSession, folders: list[str]) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in folders:
        at = path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def few(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker holds few texts and results besides Spark's own batch."""
    return (batch.slice(at, rows) for batch in batches for at in range(0, len(batch), rows))


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """From here on the session hands Python at most ``rows`` rows at once; fewer stay fewer.

    An executor holds a batch of each running task twice, in the worker and outside the heap of the JVM.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:  # 0 and less are no bound
        spark.conf.set(key, rows)


def fields_and(kept: list[T.StructField], ddl: str) -> T.StructType:
    """A schema of kept fields followed by those that ``ddl`` names."""
    return T.StructType([*kept, *T.StructType.fromDDL(ddl).fields])
