"""Checks of configuration documents: each returns a list of problems, empty if there are none."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from typing import Any

from loomery.sources.writers import ADAPTERS

# Fixed values of the documents.
SUBJECT_MODES = ("required", "optional", "forbidden")
SEED_MODES = ("fixed", "increment", "random")
BATCH_TYPES = ("expression_sheet", "variant_board", "moodboard", "silhouette_grid", "continuity_pack")
LAYOUTS = ("grid", "moodboard", "sheet", "strip")
PROFILE_FIELDS = ("profile_id", "label", "target_family", "asset_type", "eligible_lanes", "adapter_targets")
BARE_SUFFIXES = ("style", "character", "anime", "realistic")

Check = tuple[str, Callable[[Any], bool]]


def _missing(doc: dict, names: Iterable[str]) -> list[str]:
    return [f"missing required field: {n}" for n in names if doc.get(n) is None]


def _failing(doc: dict, checks: dict[str, Check]) -> list[str]:
    """Problems of fields that are there: path -> (what must hold, test)."""
    found = []
    for path, (what, test) in checks.items():
        value: Any = doc
        for key in path.split("."):
            value = value.get(key) if isinstance(value, dict) else None
        if value is not None and not test(value):
            found.append(f"{path} {what}")
    return found


def _one_of(allowed: tuple[str, ...]) -> Check:
    return f"must be one of: {', '.join(allowed)}", lambda v: v in allowed


LIST: Check = ("must be an array", lambda v: isinstance(v, list))
SLUG: Check = ("must be lower-case letters, digits and underscores", lambda v: isinstance(v, str) and re.fullmatch(r"[a-z0-9_]+", v) is not None)


def training_profile(doc: dict) -> list[str]:
    found = _missing(doc, PROFILE_FIELDS) + _failing(doc, {"eligible_lanes": LIST, "adapter_targets": LIST, "trigger_override": SLUG, "entity_id_scope": SLUG})
    targets = doc.get("adapter_targets")
    if targets == []:
        found.append("adapter_targets must have at least one target")
    found += [f"adapter_targets has the unknown adapter {t!r}, known: {', '.join(ADAPTERS)}" for t in targets or () if isinstance(targets, list) and t not in ADAPTERS]
    if doc.get("trigger_override") in BARE_SUFFIXES:
        found.append(f"trigger_override {doc['trigger_override']!r} is a generic suffix; put a project's prefix before it")
    return found


def workflow_profile(doc: dict, required: Iterable[str], output_modes: tuple[str, ...], focus: tuple[str, ...]) -> list[str]:
    found = _missing(doc, required) + _failing(
        doc,
        {
            "subject_mode": _one_of(SUBJECT_MODES), "output_mode": _one_of(output_modes), "prompt_strategy.style_prefix": LIST, "prompt_strategy.must_include": LIST, "negative_strategy.must_avoid": LIST,
            "prompt_strategy.structure": ("must be a string", lambda v: isinstance(v, str)), "canon_focus": LIST, "drift_guards": LIST, "runtime_defaults.seed_mode": _one_of(SEED_MODES),
        },
    )
    count = doc.get("output_count")
    if not isinstance(count, int) or isinstance(count, bool) or count < 1:
        found.append("output_count must be a positive integer")
    found += [f"canon_focus has the unknown item {x!r}" for x in doc.get("canon_focus") or () if isinstance(doc["canon_focus"], list) and x not in focus]
    if doc.get("runtime_defaults") is not None and not doc["runtime_defaults"].get("adapter_target"):
        found.append("runtime_defaults.adapter_target is required")
    return found


def batch_mode(doc: dict) -> list[str]:
    found = _missing(doc, ("mode_id", "label", "base_workflow_id", "batch_type", "assembly")) + _failing(doc, {"batch_type": _one_of(BATCH_TYPES), "subject_mode": _one_of(SUBJECT_MODES), "assembly.layout": _one_of(LAYOUTS)})
    if isinstance(doc.get("assembly"), dict) and not doc["assembly"].get("layout"):
        found.append("assembly.layout is required")
    slots = doc.get("variant_plan")
    if not isinstance(slots, list) or not slots:
        return [*found, "variant_plan must be a non-empty array"]
    found += [f"a slot lacks {k}" for s in slots for k in ("slot_id", "label") if not s.get(k)]
    return found + [f"duplicate slot_id {k!r}" for k, n in Counter(s.get("slot_id") for s in slots if s.get("slot_id")).items() if n > 1]


def training_manifest(manifest: dict, export_hash: str | None, config_fingerprint: str, profile_ids: Iterable[str]) -> list[str]:
    """What no longer fits: the export (its current hash, None if it is gone), the configuration, the profile."""
    found = []
    if export_hash is None:
        found.append(f"source export {manifest['source_export_id']!r} not found")
    elif export_hash != manifest["export_manifest_hash"]:
        found.append("export manifest hash mismatch")
    if config_fingerprint != manifest["config_fingerprint"]:
        found.append("config fingerprint mismatch")
    if manifest["training_profile_id"] not in set(profile_ids):
        found.append(f"training profile {manifest['training_profile_id']!r} not found")
    return found
