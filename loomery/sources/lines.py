"""Lines of text files with their numbers, and JSON lines whose errors name file and line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loomery.config import InputError
from loomery.schema import ROW_SCHEMA_VERSION

BLANK = r"\A\s*\z"


def numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line, value): every line of the files, blank ones too, numbered from 1 in its file.

    Large files are read in blocks by many tasks. A first pass counts the lines of each block, sums over
    the blocks of a file give where each begins, and the second pass adds the place within the block. No text is
    shuffled, sorted or kept: what is joined is a row a block. Lines end with a line feed.
    """
    # a number that no filter or pruning passes, so that both passes see the same partitions and rows
    read = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("_row")
    )
    counts = read.groupBy("file", "block").agg(F.min("_row").alias("_low"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low") + 1).alias("_shift"))
    # a row a block: 100 TB in blocks of 128 MB are 800,000 rows, some 100 MB
    placed = read.join(F.broadcast(starts), ["file", "block"], "left")
    known = F.when(F.col("_shift").isNotNull(), F.col("_row") + F.col("_shift")).otherwise(F.raise_error(F.concat(F.lit("files changed while they were read: "), F.col("file"))).cast("bigint"))
    return placed.select("file", known.alias("line"), "value")


def problems(lines: DataFrame, version: str = ROW_SCHEMA_VERSION) -> DataFrame:
    """(file, line, problem) of lines that aren't blank and aren't JSON, or have another schema_version."""
    parsed = F.try_parse_json("value")
    found = F.try_variant_get(parsed, "$.schema_version", "string")
    problem = F.when(parsed.isNull(), "not valid JSON").when(~F.coalesce(found == version, F.lit(False)), F.concat(F.lit("has schema_version "), F.coalesce(found, F.lit("none")), F.lit(f", expected {version}")))
    return lines.where(~F.col("value").rlike(BLANK)).select("file", "line", problem.alias("problem")).where("problem is not null")


def strict_rows(spark: SparkSession, path: str | list[str], ddl: str, version: str = ROW_SCHEMA_VERSION) -> DataFrame:
    """Rows of JSON lines; the first wrong line, by file and line, is an error. Blank lines are no rows."""
    lines = numbered(spark, path)
    first = problems(lines, version).agg(F.min(F.struct("file", "line", "problem")).alias("x")).first()["x"]
    if first:
        raise InputError("ROWS_INVALID", f"line {first['line']} of {first['file']}: {first['problem']}")
    return lines.where(~F.col("value").rlike(BLANK)).select("file", "line", F.from_json("value", ddl).alias("x")).select("file", "line", "x.*")
