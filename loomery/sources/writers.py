"""Writers: packages as partitioned files, checksums over what was written, adapters by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomery.config import InputError, TrainingProfile
from loomery.functions.scalars import truthy
from loomery.operators import rows as row_ops
from loomery.operators.export import checksum_lines


def snapshot(path: str, included: DataFrame, excluded: DataFrame, summary: DataFrame, dry_run: bool = False) -> None:
    """Three relations of a snapshot; an existing one is an error, a dry run writes nothing."""
    if dry_run:
        return
    for name, frame in (("included", included), ("excluded", excluded), ("summary", summary)):
        frame.write.mode("errorifexists").json(f"{path}/{name}")


def split(path: str, assigned: DataFrame) -> None:
    assigned.write.mode("errorifexists").partitionBy("part").json(f"{path}/assignments")


def append_events(path: str, events: DataFrame) -> None:
    """Adds events to the log; fails if a required field is missing."""
    for name in ("at", "type", "entity_id"):
        events = events.withColumn(name, F.when(F.col(name).isNotNull(), F.col(name)).otherwise(F.raise_error(F.lit(f"event without {name}"))))
    events.write.mode("append").json(path)


def dataset(path: str, training_rows: DataFrame) -> None:
    """Rows as JSON lines, foldered by lane and partition so that readers can prune."""
    order = [k for k in row_ops.KEYS if k in training_rows.columns] + sorted(set(training_rows.columns) - set(row_ops.KEYS))
    out = training_rows.select(F.coalesce("lane", F.lit("none")).alias("by_lane"), F.coalesce("partition", F.lit("other")).alias("by_partition"), F.to_json(F.struct(*order), {"ignoreNullFields": "false"}).alias("value"))
    out.write.mode("overwrite").partitionBy("by_lane", "by_partition").text(path)


def swapped(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write to a fresh folder beside ``path`` and rename it into place.

    The old folder is renamed aside first and deleted last: a failed write or rename leaves it, in place or beside.
    What a failed write has left is deleted.
    """
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    nonce = uuid.uuid4().hex[:8]
    staged, aside = (f"{path.rstrip('/')}.{what}-{nonce}" for what in ("staging", "old"))
    try:
        write(staged)
    except BaseException:
        fs.delete(at(staged), True)
        raise
    there = fs.exists(at(path))
    if there and not fs.rename(at(path), at(aside)):
        raise OSError(f"could not move {path} aside; the new data are in {staged}")
    if not fs.rename(at(staged), at(path)):
        if there:
            fs.rename(at(aside), at(path))
        raise OSError(f"could not move {staged} to {path}")
    if there:
        fs.delete(at(aside), True)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(name, line) for every file of a package, in order of names."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.replace(F.regexp_replace("path", r"\A[a-z]+:/+", "/"), F.lit(path.rstrip("/") + "/"), F.lit(""))
    return checksum_lines(files, name, F.col("content")).orderBy("name")


def put(spark: SparkSession, path: str, content: str) -> None:
    """A small text as one file, written by the driver: beside its name first, then renamed."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, partial = at(path), at(f"{path}.{uuid.uuid4().hex}.partial")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(partial, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    if not fs.rename(partial, target):
        fs.delete(partial, False)
        raise OSError(f"could not write {path}")


def placed_rows(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Training rows whose asset is in ``listing`` (path), with the file they get: dataset/<partition>/<entity_id><extension>."""
    there = listing.select(F.col("path").alias("asset_path")).distinct()
    extension = F.regexp_extract("asset_path", r"(\.[^./\\]+)\z", 1)
    stem = F.concat(F.lit("dataset/"), F.coalesce("partition", F.lit("other")), F.lit("/"), F.col("entity_id"))
    return rows.where(truthy(F.col("asset_path")).isNotNull()).join(there, "asset_path", "left_semi").withColumns({"file": F.concat(stem, extension), "caption_file": F.concat(stem, F.lit(".txt"))})


def sidecars(placed: DataFrame) -> DataFrame:
    """(name, content): a text file with each row's caption."""
    return placed.select(F.col("caption_file").alias("name"), F.concat(F.col("caption"), F.lit("\n")).cast("binary").alias("content"))


def _audit(*more: str) -> Callable[[DataFrame], DataFrame]:
    """Audit rows of an adapter; ``more`` are columns that only some adapters have."""
    columns = {"file": "file", "caption_file": "caption_file", "record_id": "entity_id", "caption": "caption", "lane": "lane", "group": "group", "subject": "subject_filter_key", "pass_ratio": "pass_ratio"}
    kept = [n for n in columns if n not in ("caption_file", "subject") or n in more]
    return lambda placed: placed.select(F.coalesce("partition", F.lit("other")).alias("partition"), *(F.col(columns[n]).alias(n) for n in kept))


#: Adapters by name: the audit rows of a package, of rows that ``placed_rows`` gives.
ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {"generic-image-caption": _audit(), "diffusers-lora": _audit("caption_file", "subject"), "ai-toolkit": _audit("caption_file", "subject")}
#: Adapters whose captions are files of their own.
WITH_SIDECARS = ("diffusers-lora", "ai-toolkit")


def adapted(rows: DataFrame, profile: TrainingProfile, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(placed rows, audit rows) by the profile's adapter; one of them takes only one family of models."""
    if profile.adapter not in ADAPTERS:
        raise InputError("ADAPTER_UNKNOWN", f"no adapter {profile.adapter!r}", f"known: {', '.join(ADAPTERS)}")
    if profile.adapter == "ai-toolkit" and profile.target_family != "flux":
        raise InputError("ADAPTER_TARGET_FAMILY_MISMATCH", f"ai-toolkit takes target_family flux, not {profile.target_family!r}", "take diffusers-lora for other families")
    placed = placed_rows(row_ops.for_profile(rows, profile), listing)
    return placed, ADAPTERS[profile.adapter](placed)
