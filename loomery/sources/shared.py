"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to spark.checkpoint.dir. A temporary folder is set only on a single machine where none is configured; a cluster must name one."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="loomery-"))
    return df.checkpoint()


def scratch(spark: SparkSession, label: str) -> str:
    """A folder of its own in spark.checkpoint.dir, for state that a query builds and reads."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="loomery-")
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def long_cells(spark: SparkSession) -> None:
    """Parquet writers of the session look at the size of pages and row groups after each row.

    Otherwise they wait for 100 rows, or for up to 10,000 after short ones, and hold all of them, however long.
    """
    for end in ("min", "max"):
        spark.conf.set(f"parquet.page.size.row.check.{end}", "1")
