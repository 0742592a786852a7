"""Export packages: metadata by a field list, image placement, checksums, implementation packs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomery.config import ExportProfile, TrainingProfile
from loomery.functions.scalars import joined, ratio, safe_path, truthy


def metadata(selected: DataFrame, located: DataFrame, profile: ExportProfile) -> DataFrame:
    """Fields of the profile plus detected_lane and detected_group for included ids; ids without a record fall out."""
    fields = [f for f in profile.metadata_fields if f in located.columns]
    wanted = selected.select(F.col("record_id").alias("id")).distinct()
    return located.join(wanted, "id", "left_semi").select(*fields, F.col("lane").alias("detected_lane"), F.col("grp").alias("detected_group"))


def placement(selected: DataFrame, listing: DataFrame) -> DataFrame:
    """(id, asset_path, status): what would happen to each image, given a listing (path) of those that exist."""
    have = listing.select(F.col("path").alias("asset_path")).distinct().withColumn("_there", F.lit(True))
    status = F.when(truthy(F.col("asset_path")).isNull(), "no_asset").when(~safe_path(F.col("asset_path")), "unsafe_path").when(F.col("_there").isNull(), "source_missing").otherwise("placed")
    return selected.select("id", "asset_path").join(have, "asset_path", "left").select("id", "asset_path", status.alias("status"))


def checksum_lines(files: DataFrame, name: Column, content: Column) -> DataFrame:
    """(name, line): BSD style checksum of each file's bytes."""
    return files.select(name.alias("name"), F.format_string("SHA256 (%s) = %s", name, F.sha2(content, 256)).alias("line"))


def prompt_examples(assigned: DataFrame, profile: TrainingProfile, per_lane: int = 3, from_train: int = 50) -> DataFrame:
    """Approved records, the first few of each lane: test in order, then the first of train. ``assigned`` has part and is ordered by file name."""
    at = F.concat("id", F.lit(".json"))
    tested = assigned.where("part = 'test'").withColumn("_o", F.lit(0)).withColumn("_at", at)
    trained = assigned.where("part = 'train'").withColumn("_o", F.lit(1)).withColumn("_at", at).orderBy("_at").limit(from_train)
    pool = tested.unionByName(trained).where(F.col("judgment.status") == "approved")
    if profile.eligible_lanes:
        pool = pool.where(F.col("lane").isin(*profile.eligible_lanes))
    rank = F.row_number().over(Window.partitionBy("lane").orderBy("_o", "_at"))
    note = F.concat(F.lit("Use as "), F.col("lane"), F.lit(" reference for "), F.coalesce("grp", F.lit("general")), F.lit(" style"))
    return pool.withColumn("_r", rank).where(F.col("_r") <= per_lane).select(
        F.col("id").alias("record_id"), "lane", F.coalesce("grp", F.lit("unknown")).alias("group"), F.substring(F.coalesce("provenance.prompt", F.lit("")), 1, 500).alias("prompt"),
        ratio(F.col("canon.pass_count"), F.coalesce("canon.assertion_count", F.lit(0)), 0.0).alias("pass_ratio"), "asset_path", note.alias("usage_note"),
    )


def known_failures(located: DataFrame, profile: TrainingProfile, most: int = 10) -> DataFrame:
    """The first rejected records by file name that say what went wrong."""
    modes, said = F.coalesce("judgment.failure_modes", F.array().cast("array<string>")), truthy(F.col("judgment.explanation"))
    pool = located.where((F.col("judgment.status") == "rejected") & ((F.size(modes) > 0) | said.isNotNull()))
    if profile.eligible_lanes:
        pool = pool.where(F.col("lane").isin(*profile.eligible_lanes))
    lesson = F.concat(F.lit("Avoid: "), F.when(F.size(modes) > 0, joined(modes)).otherwise(F.substring(said, 1, 100)))
    return pool.orderBy(F.concat("id", F.lit(".json"))).limit(most).select(F.col("id").alias("record_id"), "lane", modes.alias("failure_modes"), said.alias("explanation"), lesson.alias("lesson"))


def subject_examples(assigned: DataFrame, most: int = 5) -> DataFrame:
    """Subjects with the most records in test and train."""
    named = assigned.where(F.col("part").isin("test", "train") & truthy(F.col("identity.subject_name")).isNotNull())
    order = F.struct(F.when(F.col("part") == "test", 0).otherwise(1).alias("o"), F.concat("id", F.lit(".json")).alias("at"), F.col("identity.faction").alias("faction"))
    counted = named.groupBy(F.col("identity.subject_name").alias("subject_name")).agg(F.count("*").alias("record_count"), F.min(order).alias("first"))
    top = counted.orderBy(F.col("record_count").desc(), "first").limit(most)
    note = F.format_string("%d views of %s — use to verify identity consistency", "record_count", "subject_name")
    return top.select("subject_name", "record_count", F.col("first.faction").alias("faction"), note.alias("note"))
