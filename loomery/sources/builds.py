"""One call that builds a dataset of canon entries, and does no more than what has changed asks for."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomery.config import InputError
from loomery.operators import canon
from loomery.sources import state

# Fixed value: the version of the manifest's layout.
MANIFEST_VERSION = "canon-build-manifest-1.0"
#: Drifted entries that the manifest names; the table of drift has all of them.
NAMED = 1000


@dataclass(frozen=True)
class BuildPlan:
    """What a build needs to know: configuration text and fingerprint enter every entry's hash."""

    config_text: str
    project_fingerprint: str
    schema_to_lane: dict[str, dict[str, str]]
    watch_defaults: dict[str, list[str]] = field(default_factory=dict)
    trigger: str | None = None
    context_lines: int = 200
    buckets: int = 16


@dataclass(frozen=True)
class Built:
    generated_from: str
    entities_total: int
    entities_cached: int
    entities_rebuilt: int
    removed: int
    frozen_entries: int
    drifted_entries: int
    drifted: tuple[tuple[str, str], ...]
    schema_change_full_rebuild: bool
    rewritten: tuple[tuple, ...]
    dry_run: bool = False


def latest(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the last build, if there is one."""
    path = f"{root}/manifest.json"
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect())) if state.exists(spark, path) else None


def _publish(spark: SparkSession, root: str, manifest: dict) -> None:
    """The manifest under its name at once: written beside it and renamed."""
    jvm = spark.sparkContext._jvm
    target, staged = (jvm.org.apache.hadoop.fs.Path(f"{root}/{n}") for n in ("manifest.json", ".manifest.json.new"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(staged, True)
    out.write(bytearray((json.dumps(manifest, indent=2, ensure_ascii=False) + "\n").encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(staged, target):
        raise OSError(f"could not publish {target}")


def run(
    entries: DataFrame, root: str, plan: BuildPlan, generated_from: str, only: DataFrame | None = None, full: bool = False, no_cache: bool = False, dry_run: bool = False, context: Callable[[DataFrame], DataFrame] | None = None
) -> Built:
    """Build the entries (id, schema_kind, entry, source, schema_version) into ``root``.

    ``root`` holds rows (the training rows of all entries, by lane and bucket), cache (renderings by entry hash and id), drift
    (id, freeze_status of every entry that this build found drifted) and manifest.json. An entry whose hash is in the cache isn't rendered again, unless ``full``,
    ``no_cache`` or a new schema version says so; rows that don't change keep their partition's files. ``only`` (id) builds these
    entries and leaves the rest; without it entries that are gone lose their rows. Drift compares the
    watched fields of entries that aren't auto with those of the last build: all are counted, the first thousand by id are named
    in what is returned and in the manifest. ``context`` renders (id,
    context) of entries; one of over ``context_lines`` lines fails the build before anything is
    written. A dry run plans and counts only.
    """
    spark = entries.sparkSession
    if only is not None:
        entries = entries.join(only.select("id").distinct(), "id", "left_semi")
    if bad := entries.groupBy("id").count().where("count > 1").head(1):
        raise InputError("CANON_ENTRY_REPEATED", f"two entries have the id {bad[0]['id']!r}")
    before = latest(spark, root)
    # what the last build had, by kind: as many rows as there are schemas
    versions = {r["schema_kind"]: r["schema_version"] for r in entries.groupBy("schema_kind").agg(F.max("schema_version").alias("schema_version")).collect()}
    known = before["schema_versions"] if before else {}
    changed_schema = bool(before) and any(known.get(k) != v for k, v in versions.items())
    now = canon.lanes_of(canon.hashed(canon.with_watch_hash(entries, plan.watch_defaults), plan.config_text, plan.project_fingerprint), plan.schema_to_lane)
    if wrong := now.where(F.col("lane_error").isNotNull()).head(1):
        raise InputError("CANON_LANE", f"{wrong[0]['id']}: {wrong[0]['lane_error']}")
    if context is not None and (long := canon.over_length(context(entries), plan.context_lines).select("id", "lines").head(1)):
        raise InputError("CANON_CONTEXT_LENGTH_EXCEEDED", f"{long[0]['id']} has {long[0]['lines']} lines of context, {plan.context_lines} are allowed")

    rows_now = lambda some: canon.rows(some, plan.trigger, generated_from)
    kept = [c for c in rows_now(now).columns if c not in ("generated_from", "entry_hash")]
    cache_path, rows_path = f"{root}/cache", f"{root}/rows"
    rendered_schema = rows_now(now).select("entry_hash", *kept).schema
    cache = state.read(spark, cache_path, rendered_schema)
    full_run = full or no_cache or changed_schema
    # equal sources of two entries have one hash, so a rendering belongs to hash and id
    cached = cache.select("entry_hash", F.col("entity_id").alias("id"))
    fresh = now if full_run else now.join(cached, ["entry_hash", "id"], "left_anti")
    counts = fresh.agg(F.count("*")).first()[0]
    total = now.agg(F.count("*"), F.count_if(F.col("freeze_status") != "auto")).first()

    made = rows_now(fresh).select("entry_hash", *kept)
    held = cache.join(fresh.select("entry_hash", F.col("id").alias("entity_id")), ["entry_hash", "entity_id"], "left_anti")
    stamps = now.select("entry_hash", F.col("id").alias("entity_id"), "freeze_status", "watch_fields", "watch_hash")
    lines = made.unionByName(held).join(stamps, ["entry_hash", "entity_id"])
    target = state.bucketed(lines, ["entity_id"], plan.buckets)
    old = state.read(spark, rows_path, target.schema)
    drifted = canon.drift(now, old.where("freeze_status <> 'auto'").select(F.col("entity_id").alias("id"), F.col("watch_hash").alias("witness_hash"))).where("drift = 'drifted'").select("id", "freeze_status")
    if not dry_run:
        drifted.write.mode("overwrite").parquet(f"{root}/drift")
        drifted = spark.read.schema(drifted.schema).parquet(f"{root}/drift")
    found = (drifted.count(), tuple((r["id"], r["freeze_status"]) for r in drifted.orderBy("id").limit(NAMED).collect()))
    gone = None if only is not None else old.join(now.select(F.col("id").alias("entity_id")), "entity_id", "left_anti").select("entity_id")
    if dry_run:
        return Built(generated_from, total[0], total[0] - counts, counts, 0, total[1], *found, changed_schema, (), True)
    # renderings first: a build that fails after this finds them again
    if not no_cache and counts:
        made.join(cache.select("entry_hash", "entity_id"), ["entry_hash", "entity_id"], "left_anti").write.mode("append").parquet(cache_path)
    merged = state.upsert(rows_path, target, ["entity_id"], ["lane", state.BUCKET], gone)
    built = Built(generated_from, total[0], total[0] - counts, counts, merged.deleted, total[1], *found, changed_schema, merged.rewritten)
    manifest = {"schema_version": MANIFEST_VERSION, "generated_from": generated_from, "schema_versions": known | versions if only is not None else versions, "project_config_fingerprint": plan.project_fingerprint}
    _publish(spark, root, manifest | {"stats": {k: v for k, v in asdict(built).items() if k not in ("generated_from", "rewritten", "dry_run", "drifted")}, "drift_against_prior": [list(d) for d in built.drifted]})
    return built


def rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows that the builds so far have left."""
    return spark.read.parquet(f"{root}/rows")


def drift(spark: SparkSession, root: str) -> DataFrame:
    """(id, freeze_status): all entries that the last build found drifted."""
    return spark.read.parquet(f"{root}/drift")
