"""Packages: exports of a snapshot and training packages, with manifests and checksums."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomery.config import ExportProfile, InputError, TrainingProfile
from loomery.functions.captions import style_trigger
from loomery.functions.scalars import safe_path, truthy
from loomery.operators import export, rows as row_ops
from loomery.sources import sink, writers
from loomery.sources.readers import MANIFEST_VERSION

PARTS = ("train", "val", "test")


def _fresh(spark: SparkSession, path: str, code: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        raise InputError(code, f"{path} is there already", "take a fresh identifier")


def _json(spark: SparkSession, path: str, value: dict[str, Any]) -> None:
    writers.put(spark, path, json.dumps(value, indent=2, ensure_ascii=False) + "\n")


def _with_checksums(spark: SparkSession, path: str) -> None:
    """checksums over all files written so far, a line each, as a folder of text whose parts follow each other in order of names."""
    writers.checksums(spark, path).select("line").write.mode("errorifexists").text(f"{path}/checksums")


def drift_error(snapshot_fingerprint: str | None, current: str) -> None:
    if snapshot_fingerprint and snapshot_fingerprint != current:
        raise InputError("FINGERPRINT_DRIFT", f"configuration has changed since the snapshot: {snapshot_fingerprint[:16]} then, {current[:16]} now", "take a fresh snapshot, or undo the change")


def unsafe_assets(selected: DataFrame) -> DataFrame:
    """(id, asset_path) of assets whose path is absolute or leads out of the project."""
    return selected.where(truthy(F.col("asset_path")).isNotNull() & ~safe_path(F.col("asset_path"))).select("id", "asset_path")


def image_plan(selected: DataFrame, listing: DataFrame) -> DataFrame:
    """(id, asset_path, status, file): where each record's image goes; files are named by ids, so that shared names don't meet."""
    plan = export.placement(selected, listing)
    extension = F.regexp_extract("asset_path", r"(\.[^./\\]+)\z", 1)
    return plan.withColumn("file", F.when(F.col("status") == "placed", F.concat(F.lit("images/"), F.col("id"), extension)))


def export_package(
    spark: SparkSession, path: str, included: DataFrame, located: DataFrame, assigned: DataFrame, profile: ExportProfile, ids: dict[str, str], snapshot_fingerprint: str | None, current_fingerprint: str, images: DataFrame | None = None, card: str | None = None, assets: str | None = None, placement: str = "copy"
) -> dict[str, Any]:
    """Write an export and return its manifest.

    included: (record_id); located: records with lane and grp; assigned: (record_id, part, ...). ids: export_id,
    snapshot_id, split_id, created_at, project. Images come from ``images`` (path, content), or from the folder
    ``assets``, copied or linked by ``placement``; without either they are only planned. One that can't be placed
    is a row of images/_failures, a warning and a count. The package shows
    when it is whole; a failed one leaves nothing.
    """
    _fresh(spark, path, "EXPORT_ID_COLLISION")
    drift_error(snapshot_fingerprint, current_fingerprint)
    rows = export.metadata(included, located, profile)
    chosen = located.join(included.select(F.col("record_id").alias("id")).distinct(), "id", "left_semi").select("id", "asset_path")
    if profile.include_images and (bad := unsafe_assets(chosen).head(1)):
        raise InputError("ASSET_PATH_INVALID", f"asset path of {bad[0]['id']} leads out of the project: {bad[0]['asset_path']}")
    made: list[dict[str, Any]] = []

    def write(staged: str) -> None:
        rows.write.mode("errorifexists").json(f"{staged}/metadata")
        written = spark.read.schema(rows.schema).json(f"{staged}/metadata").count() if rows.columns else 0
        report: dict[str, Any] = {"counts": {}, "sample": []}
        if profile.include_images:
            wanted = chosen.where(truthy(F.col("asset_path")).isNotNull())
            name = F.concat("id", F.regexp_extract("asset_path", r"(\.[^./\\]+)\z", 1)).alias("name")
            files = wanted.select(F.col("id").alias("record_id"), name, "asset_path")
            if assets is not None:
                report = sink.place(files.withColumn("source", F.concat(F.lit(f"{sink.qualified(spark, assets)}/"), "asset_path")), f"{staged}/images", placement)
            elif images is not None:
                report = sink.place(files.join(images.select(F.col("path").alias("asset_path"), "content"), "asset_path", "left"), f"{staged}/images", placement)
            else:
                report["counts"] = {"source_missing": files.count()}
                report["sample"] = [{"record_id": r["record_id"], "reason": "source_missing"} for r in files.orderBy("record_id").limit(10).collect()]
        if profile.include_splits:
            assigned.where(F.col("part").isin(*PARTS)).write.mode("errorifexists").partitionBy("part").json(f"{staged}/splits")
        if profile.include_card and card is not None:
            writers.put(spark, f"{staged}/dataset-card.md", card)
        expected, placed = sum(report["counts"].values()), report["counts"].get("placed", 0)
        warnings = ["images are links: the package can't be moved to another machine"] if placement == "link" and placed else []
        warnings += [f"{expected - placed} of {expected} images failed to place"] if expected > placed else []
        manifest = {
            "schema_version": MANIFEST_VERSION, **ids, "config_fingerprint": snapshot_fingerprint or current_fingerprint, "profile": profile.__dict__ | {"metadata_fields": list(profile.metadata_fields)}, "warnings": warnings,
            "counts": {"records": written, "images": placed, "images_expected": expected, "images_actual": placed, "images_failed": expected - placed},
            "images_failed": [{"record_id": f["record_id"], "reason": f["reason"]} for f in report["sample"]],
        }
        _json(spark, f"{staged}/manifest.json", manifest)
        if profile.include_checksums:
            _with_checksums(spark, staged)
        made.append(manifest)

    writers.swapped(spark, path, write)
    return made[0]


# The training job that the trainer reads; a profile's hyperparameters take the place of the first three.
JOB_DEFAULTS = {"rank": 32, "steps": 2500, "model": "black-forest-labs/FLUX.1-dev"}


def training_job(profile: TrainingProfile, source_export_id: str | None) -> dict[str, Any]:
    """Configuration of a training job by the profile's hyperparameters and model."""
    given = profile.training_hyperparameters
    rank = given.get("rank") or JOB_DEFAULTS["rank"]
    model = next(iter(profile.base_model_recommendations), JOB_DEFAULTS["model"])
    trigger = style_trigger(profile) or profile.profile_id
    process = {
        "type": "sd_trainer",
        "training_folder": "output",
        "device": "cuda:0",
        "network": {"type": "lora", "linear": rank, "linear_alpha": given.get("alpha") or rank},
        "save": {"dtype": "float16", "save_every": 250, "max_step_saves_to_keep": 4},
        "datasets": [{"folder_path": "./dataset/train", "caption_ext": "txt", "caption_dropout_rate": 0.05, "shuffle_tokens": False, "cache_latents_to_disk": True, "resolution": [512, 768, 1024]}],
        "train": {
            "batch_size": 1, "steps": given.get("steps") or JOB_DEFAULTS["steps"], "gradient_accumulation_steps": 1, "train_unet": True, "train_text_encoder": False, "gradient_checkpointing": True,
            "noise_scheduler": "flowmatch", "optimizer": "adamw8bit", "lr": 4e-4, "ema_config": {"use_ema": True, "ema_decay": 0.99}, "dtype": "bf16",
        },
        "model": {"name_or_path": model, "is_flux": True, "quantize": True},
        "is_style": profile.is_style_lora is True,
        "sample": {"sampler": "flowmatch", "sample_every": 250, "width": 1024, "height": 1024, "prompts": [f"{trigger} style sample prompt"], "neg": "", "seed": 42, "walk_seed": True, "guidance_scale": 4, "sample_steps": 20},
    }
    return {"job": "extension", "config": {"name": f"{profile.profile_id}-{source_export_id or 'unknown'}", "process": [process]}, "meta": {"name": profile.profile_id, "version": "1.0"}}


def training_package(
    spark: SparkSession, path: str, rows: DataFrame, profile: TrainingProfile, images: DataFrame, ids: dict[str, str], config_fingerprint: str, readme: Callable[[dict[str, Any]], str] | None = None
) -> dict[str, Any]:
    """Write a training package by the profile's adapter and return its manifest.

    rows: training rows of all partitions; images: (path, content) of assets. ids: training_package_id,
    training_manifest_id, source_export_id, source_snapshot_id, source_split_id, created_at.
    """
    _fresh(spark, path, "TRAINING_PACKAGE_ID_COLLISION")
    placed, audit = writers.adapted(rows, profile, images.select("path"))
    made: list[dict[str, Any]] = []

    def write(staged: str) -> None:
        audit.write.mode("errorifexists").partitionBy("partition").json(f"{staged}/metadata")
        files = placed.join(images.select(F.col("path").alias("asset_path"), "content"), "asset_path", "left").select(F.col("entity_id").alias("record_id"), F.substring("file", len("dataset/") + 1, 4096).alias("name"), "content")
        if profile.adapter in writers.WITH_SIDECARS:
            files = files.unionByName(writers.sidecars(placed).select(F.lit(None).cast("string").alias("record_id"), F.substring("name", len("dataset/") + 1, 4096).alias("name"), "content"))
        report = sink.place(files, f"{staged}/dataset")
        sidecars = placed.count() if profile.adapter in writers.WITH_SIDECARS else 0
        n_images = report["counts"]["placed"] - sidecars
        if profile.adapter == "ai-toolkit":
            import yaml

            writers.put(spark, f"{staged}/ai-toolkit-config.yaml", yaml.safe_dump(training_job(profile, ids.get("source_export_id")), sort_keys=False))
        counts = {r["partition"]: r["n"] for r in row_ops.partition_counts(row_ops.for_profile(rows, profile)).collect()}
        manifest = {
            "schema_version": MANIFEST_VERSION, **ids, "training_profile_id": profile.profile_id, "adapter_target": profile.adapter, "config_fingerprint": config_fingerprint,
            "counts": {"total_records": sum(counts.values()), **{p: counts.get(p, 0) for p in PARTS}, "images": n_images},
        }
        _json(spark, f"{staged}/manifest.json", manifest)
        said = readme(manifest) if readme else f"# {ids.get('training_package_id')}\n\n{manifest['counts']['total_records']} rows, {n_images} images, adapter {profile.adapter}.\n"
        writers.put(spark, f"{staged}/README.md", said)
        _with_checksums(spark, staged)
        made.append(manifest)

    writers.swapped(spark, path, write)
    return made[0]
