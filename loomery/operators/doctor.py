"""Data-quality relations: duplicates, dangling references, labels that don't add up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dangling(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """(value, n): keys of ``child`` that ``parent`` hasn't, nulls aside."""
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("value")).agg(F.count("*").alias("n"))
    return keys.join(parent.select(F.col(parent_key).alias("value")).distinct(), "value", "left_anti")


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def checks(spark, **counts: DataFrame) -> DataFrame:
    """(check, problems, ok) for named relations of problems."""
    out = None
    for name, found in counts.items():
        row = found.agg(F.count("*").alias("problems")).select(F.lit(name).alias("check"), "problems", (F.col("problems") == 0).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame([], "check string, problems bigint, ok boolean")
