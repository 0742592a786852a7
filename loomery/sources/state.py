"""State tables that changes are merged into: only partitions that change are rewritten."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from loomery.config import InputError

#: Folder level that deals a state's rows; a change rewrites the rows that share it.
BUCKET = "bucket"


@dataclass(frozen=True)
class Merge:
    """What a merge found and did; partitions are (values of the partition columns)."""

    inserted: int
    updated: int
    deleted: int
    unchanged: int
    rewritten: tuple[tuple, ...]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in whatever filesystem its path names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The state with exactly the columns of ``schema``; empty where nothing was written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def bucketed(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    """``df`` with the bucket of each row's key."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def _same(names: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names))


def upsert(path: str, changes: DataFrame, key: list[str], partitions: list[str], deleted: DataFrame | None = None) -> Merge:
    """Merge rows into the state at ``path``: new keys are added, others replaced, keys of ``deleted`` go.

    Rows equal to the state's are no change. A partition without a change keeps its
    files; one with a change is read, merged and overwritten (dynamic partition
    overwrite), so that a merge that is run again after a failure gives the same state. A row may move
    between partitions; both are then rewritten, and a partition that loses all rows goes. Repeated keys
    among the changes, or one both changed and deleted, are an error. Partition columns must be of a configured number of
    values (lanes, buckets): the list of changed partitions is all that is collected.
    """
    spark, names = changes.sparkSession, changes.columns
    others = [n for n in names if n not in key]
    asked = changes.select(*key, F.lit(False).alias("_gone"))
    if deleted is not None:
        asked = asked.unionByName(deleted.select(*key, F.lit(True).alias("_gone")))
    if bad := asked.groupBy(*key).count().where("count > 1").head(1):
        raise InputError("STATE_KEY_REPEATED", f"changes name {', '.join(f'{k}={bad[0][k]!r}' for k in key)} more than once")
    state = read(spark, path, changes.schema)
    new = changes.withColumn("_new", F.lit(True)).alias("n")
    old = state.withColumn("_old", F.lit(True)).alias("o")
    pairs = new.join(old, _same(key, "n", "o"), "left")
    kind = F.when(F.col("_old").isNull(), "inserted").when(_same(others, "n", "o") if others else F.lit(True), "unchanged").otherwise("updated")
    where = lambda side: F.struct(*(F.col(f"{side}.{p}").alias(p) for p in partitions))
    found = pairs.select(kind.alias("kind"), where("n").alias("to"), F.when(F.col("_old").isNotNull(), where("o")).alias("was"))
    if deleted is not None:
        gone = deleted.select(*key).alias("n").join(old, _same(key, "n", "o")).select(F.lit("deleted").alias("kind"), F.lit(None).cast(found.schema["to"].dataType).alias("to"), where("o").alias("was"))
        found = found.unionByName(gone)
    counted = found.groupBy("kind", "to", "was").count().collect()  # at most the square of the partitions
    counts = {k: sum(r["count"] for r in counted if r["kind"] == k) for k in ("inserted", "updated", "deleted", "unchanged")}
    touched = sorted({tuple(p) for r in counted if r["kind"] != "unchanged" for p in (r["to"], r["was"]) if p is not None}, key=repr)
    if touched:
        # literals, so that the scan prunes partitions
        here = reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partitions, values))) for values in touched))
        kept = state.where(here).alias("n").join(asked.alias("o"), _same(key, "n", "o"), "left_anti")
        merged = kept.select(*names).unionByName(changes.where(here))
        left = {tuple(r) for r in merged.select(*partitions).distinct().collect()} if exists(spark, path) else set(touched)
        merged.repartition(*partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
        for values in set(touched) - left:
            for folder in spark.read.schema(changes.schema).parquet(path).where(reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partitions, values)))).select(F.input_file_name().alias("f")).distinct().collect():
                remove(spark, folder["f"].rpartition("/")[0])
    return Merge(**counts, rewritten=tuple(touched))


def judged(path: str, judgments: DataFrame, buckets: int = 64) -> Merge:
    """Merge judgments (id and further columns; one row an id) into the state of judgments."""
    return upsert(path, bucketed(judgments, ["id"], buckets), ["id"], [BUCKET])
