"""Project configuration: small driver-side values that become literals in expressions."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field, fields, replace
from datetime import datetime, timezone
from pathlib import Path
from typing import Any


class InputError(ValueError):
    """A mistake in what was given: exit code 1, where runtime failures have 2."""

    exit_code = 1

    def __init__(self, code: str, message: str, hint: str = "") -> None:
        super().__init__(message)
        self.code, self.hint = code, hint


@dataclass(frozen=True)
class Lane:
    id: str
    patterns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Lanes:
    lanes: tuple[Lane, ...] = ()
    default: str | None = None


@dataclass(frozen=True)
class Group:
    name: str
    id_patterns: tuple[str, ...] = ()
    prompt_patterns: tuple[str, ...] = ()
    material: str | None = None
    shapes: str | None = None
    wear: str | None = None
    construction: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Terminology:
    groups: tuple[Group, ...] = ()
    id_order: tuple[str, ...] | None = None
    prompt_order: tuple[str, ...] | None = None
    cross_group: tuple[tuple[str, str], ...] = ()
    edge_defaults: tuple[tuple[str, str], ...] = ()
    null_patterns: tuple[str, ...] = ()
    id_fallbacks: tuple[tuple[str, str], ...] = ()
    context: dict[str, str] = field(default_factory=dict)

    def ordered(self, names: tuple[str, ...] | None) -> list[Group]:
        by_name = {g.name: g for g in self.groups}
        return [by_name[n] for n in (names or by_name) if n in by_name]


@dataclass(frozen=True)
class Rule:
    id: str
    category: str = ""
    dims: tuple[str, ...] = ()
    lanes: tuple[str, ...] | None = None
    group_specific: bool = False
    desc: str = ""
    rationale_pass: str | None = None
    rationale_fail: str | None = None


#: Verdict thresholds by status: (pass at or above, partial at or above); a rejected record fails below the second.
DEFAULT_THRESHOLDS = {"approved": (0.7, 0.5), "borderline": (0.7, 0.5), "rejected": (0.6, 0.4)}


@dataclass(frozen=True)
class Rubric:
    dimensions: tuple[str, ...] = ()
    thresholds: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    failure_to_rules: dict[str, tuple[str, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class SelectionProfile:
    profile_id: str = "default"
    require_judgment: bool = True
    require_status: tuple[str, ...] = ("approved",)
    require_canon_bound: bool = True
    minimum_pass_ratio: float | None = 0.5
    rights_filter: str | None = None
    exclude_lanes: tuple[str, ...] = ()
    exclude_tags: tuple[str, ...] = ()
    # declared but without effect by default, as selection has always been; see operators.snapshot.capped
    max_per_subject: int | None = None
    max_per_lane: int | None = None


@dataclass(frozen=True)
class SplitProfile:
    profile_id: str = "balanced-default"
    train_ratio: float = 0.8
    val_ratio: float = 0.1
    test_ratio: float = 0.1
    seed: int = 42


@dataclass(frozen=True)
class ExportProfile:
    profile_id: str = "canonical-package"
    include_images: bool = True
    image_strategy: str = "symlink"
    include_splits: bool = True
    include_card: bool = True
    include_checksums: bool = True
    metadata_fields: tuple[str, ...] = ("id", "asset_path", "provenance", "judgment", "canon", "identity", "lineage")


@dataclass(frozen=True)
class TrainingProfile:
    profile_id: str
    adapter: str = "generic-image-caption"
    eligible_lanes: tuple[str, ...] = ()
    caption_strategy: str = "legacy"
    prompt_strategy: str | None = None
    style_trigger: str | None = None
    entity_id_scope: str | None = None
    target_family: str | None = None
    base_model_recommendations: tuple[str, ...] = ()
    training_hyperparameters: dict[str, Any] = field(default_factory=dict)
    is_style_lora: bool = False


@dataclass(frozen=True)
class Project:
    lanes: Lanes = Lanes()
    terminology: Terminology = Terminology()
    rules: tuple[Rule, ...] = ()
    rubric: Rubric = Rubric()
    constitution_version: str = "1.0.0"


def overlay(profile: Any, given: dict[str, Any] | None) -> Any:
    """Defaults with the keys that a file sets; unknown keys are ignored, lists become tuples."""
    known = {f.name for f in fields(profile)}
    return replace(profile, **{k: tuple(v) if isinstance(v, list) else v for k, v in (given or {}).items() if k in known})


def read_json(path: str | Path, required: tuple[str, ...] = ()) -> Any:
    """A JSON file; None if it is missing. ``required`` names top-level fields that must be there."""
    try:
        text = Path(path).read_text(encoding="utf-8")
    except FileNotFoundError:
        return None
    try:
        value = json.loads(text)
    except ValueError as e:
        raise InputError("CONFIG_INVALID", f"{path} is not valid JSON ({e})") from e
    missing = [k for k in required if not isinstance(value, dict) or k not in value]
    if missing:
        raise InputError("CONFIG_FIELDS", f"{path} lacks {', '.join(missing)}")
    return value


def load_profile(root: str | Path, folder: str, profile_id: str | None, default: Any) -> Any:
    """The default, overlaid by ``folder/<id>.json``; an unknown id gives the default."""
    return overlay(default, read_json(Path(root, folder, f"{profile_id}.json")) if profile_id else None)


def _pairs(value: dict[str, str] | None) -> tuple[tuple[str, str], ...]:
    return tuple((value or {}).items())


def load_project(root: str | Path) -> Project:
    """The project's configuration files; the constitution is required, others have defaults."""
    root = Path(root)
    constitution = read_json(root / "constitution.json")
    if constitution is None:
        raise InputError("CONSTITUTION_MISSING", f"no constitution.json in {root}")
    rules = constitution if isinstance(constitution, list) else constitution.get("rules", [])
    lanes, rubric, terms = (read_json(root / f"{n}.json") or {} for n in ("lanes", "rubric", "terminology"))
    groups = terms.get("groups") or {}
    thresholds = dict(DEFAULT_THRESHOLDS)
    for status, keys in (("approved", ("pass", "partial")), ("borderline", ("pass", "partial")), ("rejected", ("partial_ceiling", "fail_ceiling"))):
        block = (rubric.get("thresholds") or {}).get(status)
        if isinstance(block, dict):
            thresholds[status] = (block[keys[0]], block[keys[1]])
    return Project(
        lanes=Lanes(tuple(Lane(x["id"], tuple(x.get("id_patterns") or ())) for x in lanes.get("lanes", [])), lanes.get("default_lane")),
        terminology=Terminology(
            tuple(Group(n, tuple(g.get("id_patterns") or ()), tuple(g.get("prompt_patterns") or ()), g.get("material"), g.get("shapes"), g.get("wear"), g.get("construction") or {}) for n, g in groups.items()) if isinstance(groups, dict) else (),
            tuple(terms["id_detection_order"]) if terms.get("id_detection_order") else None,
            tuple(terms["prompt_detection_order"]) if terms.get("prompt_detection_order") else None,
            _pairs(terms.get("cross_group_patterns")), _pairs(terms.get("edge_defaults")), tuple(terms.get("null_faction_patterns") or ()), _pairs(terms.get("id_fallbacks")), terms.get("faction_context") or {},
        ),
        rules=tuple(Rule(r["id"], r.get("category", ""), tuple(r.get("dims") or ()), tuple(r["lanes"]) if r.get("lanes") else None, bool(r.get("faction_specific")), r.get("desc", ""), r.get("rationale_pass"), r.get("rationale_fail")) for r in rules),
        rubric=Rubric(tuple(rubric.get("dimensions") or ()), thresholds, {k: tuple(v) for k, v in (rubric.get("failure_to_rules") or {}).items()}),
        constitution_version=(constitution.get("version") if isinstance(constitution, dict) else None) or "1.0.0",
    )


@dataclass(frozen=True)
class BuildConfig:
    """What a canon build reads; ``raw`` is the file's text, which enters every entry's hash."""

    project_id: str
    canon_root: str
    schema_dir: str
    entity_dirs: dict[str, str]
    schema_to_lane: dict[str, dict[str, str]]
    context_limits: dict[str, Any] = field(default_factory=dict)
    profile_id: str | None = None
    freeze_watch_defaults: dict[str, list[str]] = field(default_factory=dict)
    raw: str = ""

    def lane_rules(self) -> dict[str, dict[str, str]]:
        """The lane rules in the form that ``canon.lanes_of`` takes, by kind."""
        kind = lambda name: name.removesuffix(".json").removesuffix(".schema")
        return {kind(n): {"field": r["field"]} if r["source"] == "field" else {"lane": r["value"]} for n, r in self.schema_to_lane.items()}


def _lane_rule_mistake(rule: Any) -> str | None:
    if not isinstance(rule, dict):
        return "must be an object"
    needed = {"field": "field", "constant": "value"}.get(rule.get("source"))
    if needed is None:
        return f"has source {rule.get('source')!r}, neither field nor constant"
    return None if isinstance(rule.get(needed), str) and rule[needed] else f"lacks a text {needed!r}"


def load_build_config(path: str | Path, root: str | Path) -> BuildConfig:
    """A build's configuration. All mistakes are reported at once; relative folders are below ``root``."""
    given = read_json(path)
    if given is None:
        raise InputError("CANON_BUILD_CONFIG_NOT_FOUND", f"no build configuration at {path}")
    given = given if isinstance(given, dict) else {}
    wrong = [f"{k} is missing" for k in ("project_id", "canon_root", "schema_dir") if not given.get(k)]
    wrong += [f"{k} must be an object" for k in ("entity_dirs", "schema_to_lane") if not isinstance(given.get(k), dict)]
    rules = given.get("schema_to_lane") if isinstance(given.get("schema_to_lane"), dict) else {}
    wrong += [f"schema_to_lane of {name} {mistake}" for name, rule in rules.items() if (mistake := _lane_rule_mistake(rule))]
    if wrong:
        raise InputError("CANON_BUILD_CONFIG_INVALID", f"{path}: " + "; ".join(wrong))
    known = {f.name for f in fields(BuildConfig)} - {"raw", "canon_root", "schema_dir"}
    folders = {k: str(Path(root, given[k])) for k in ("canon_root", "schema_dir")}
    return BuildConfig(**folders, **{k: v for k, v in given.items() if k in known and v is not None}, raw=Path(path).read_text(encoding="utf-8"))


def time_id(prefix: str, at: datetime, nonce: str) -> str:
    """An identifier like export-20260131-235959-ab12: UTC day and time, and four hexadecimal digits."""
    return f"{prefix}-{at.astimezone(timezone.utc):%Y%m%d-%H%M%S}-{nonce}"


CONFIG_FILES = ("constitution.json", "lanes.json", "project.json", "rubric.json", "terminology.json")


def fingerprint(root: str | Path) -> str:
    """SHA-256 over the configuration files that exist, each under its name, in order of names."""
    parts = [f"--- {name} ---\n{path.read_text(encoding='utf-8')}\n" for name in CONFIG_FILES if (path := Path(root, name)).exists()]
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def java_pattern(pattern: str) -> str:
    """A configured pattern for Java's engine: ``$`` means the very end, as where these patterns come from.

    Escaped and bracketed dollars stay. Look-behind and back-references pass through unchecked.
    """
    out, in_class, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        in_class = (in_class or c == "[") and not (in_class and c == "]")
        out.append(r"\z" if c == "$" and not in_class else c)
        i += 1
    re.compile("".join(out).replace(r"\z", r"\Z"))
    return "".join(out)
