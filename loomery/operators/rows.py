"""Training rows: projection of records and entities, filters, grouping, and their stable JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomery.config import TrainingProfile
from loomery.functions import captions
from loomery.functions.scalars import ratio, truthy
from loomery.schema import ROW_SCHEMA_VERSION

#: Keys of a row in the order in which they are written; further ones follow by name.
KEYS = ("schema_version", "generated_from", "entity_id", "schema_kind", "entity_type", "lane", "partition", "asset_path", "caption", "trigger", "subject_filter_key", "forbidden_tokens", "entry_hash", "pass_ratio", "group")


def from_records(located: DataFrame, profile: TrainingProfile, partition: Column) -> DataFrame:
    """One row for each record with an id and an asset; ``located`` has lane and grp."""
    usable = located.where(truthy(F.col("id")).isNotNull() & truthy(F.col("asset_path")).isNotNull())
    lane, group = F.col("lane"), F.col("grp")
    return usable.select(
        F.lit(ROW_SCHEMA_VERSION).alias("schema_version"), F.lit(None).cast("string").alias("generated_from"), F.col("id").alias("entity_id"), F.lit("record").alias("schema_kind"), truthy(F.col("identity.kind")).alias("entity_type"),
        lane.alias("lane"), partition.alias("partition"), "asset_path", captions.caption(F.col, lane, group, profile).alias("caption"), F.lit(captions.style_trigger(profile)).cast("string").alias("trigger"),
        F.coalesce(truthy(F.col("identity.subject_name")), F.col("id")).alias("subject_filter_key"), F.coalesce("canon.forbidden_inputs", F.array().cast("array<string>")).alias("forbidden_tokens"),
        F.lit(None).cast("string").alias("entry_hash"), ratio(F.col("canon.pass_count"), F.coalesce("canon.assertion_count", F.lit(0)), None).alias("pass_ratio"), group.alias("group"),
    )


def for_profile(rows: DataFrame, profile: TrainingProfile) -> DataFrame:
    """Rows in the profile's lanes and of its entity; what is not set filters nothing."""
    if profile.eligible_lanes:
        rows = rows.where(F.col("lane").isin(*profile.eligible_lanes))
    if profile.entity_id_scope:
        rows = rows.where((F.col("entity_id") == profile.entity_id_scope) | (F.col("subject_filter_key") == profile.entity_id_scope))
    return rows


def partition_counts(rows: DataFrame) -> DataFrame:
    """(partition, n); a missing partition counts as other."""
    return rows.groupBy(F.coalesce(truthy(F.col("partition")), F.lit("other")).alias("partition")).agg(F.count("*").alias("n"))


def serialised(rows: DataFrame) -> DataFrame:
    """(partition, value): one JSON line a row, known keys first, others by name; nulls are written."""
    order = [k for k in KEYS if k in rows.columns] + sorted(set(rows.columns) - set(KEYS))
    return rows.select(F.coalesce("partition", F.lit("other")).alias("partition"), F.to_json(F.struct(*order), {"ignoreNullFields": "false"}).alias("value"))


def checked(rows: DataFrame) -> DataFrame:
    """The rows; fails at the first one of another schema version."""
    wrong = F.concat(F.lit("row of schema_version "), F.coalesce("schema_version", F.lit("null")), F.lit(f", expected {ROW_SCHEMA_VERSION}"))
    right = F.coalesce(F.col("schema_version") == ROW_SCHEMA_VERSION, F.lit(False))
    return rows.withColumn("schema_version", F.when(right, F.col("schema_version")).otherwise(F.raise_error(wrong)))
