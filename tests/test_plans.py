import dataclasses

import pytest

from loomery import config
from loomery.operators import split
from loomery.plans import briefs, card, testbed as t, validation
from tests.test_engine import families_frame, record, records_of


def test_validators():
    good = {"profile_id": "p", "label": "l", "target_family": "f", "asset_type": "a", "eligible_lanes": [], "adapter_targets": ["diffusers-lora"]}
    assert validation.training_profile(good) == []
    assert len(validation.training_profile(good | {"adapter_targets": ["nope"], "trigger_override": "Style-X", "label": None})) == 3
    assert validation.training_profile(good | {"trigger_override": "style"}) and validation.training_profile(good | {"adapter_targets": []})
    mode = {"mode_id": "m", "label": "l", "base_workflow_id": "w", "batch_type": "moodboard", "variant_plan": [{"slot_id": "a", "label": "A"}], "assembly": {"layout": "grid"}}
    assert validation.batch_mode(mode) == []
    assert len(validation.batch_mode(mode | {"batch_type": "x", "variant_plan": [{"slot_id": "a", "label": "A"}, {"slot_id": "a"}], "assembly": {}})) == 4
    flow = {"id": "w", "output_count": 2, "output_mode": "sheet", "canon_focus": ["palette"], "runtime_defaults": {"adapter_target": "x", "seed_mode": "fixed"}}
    assert validation.workflow_profile(flow, ("id",), ("sheet",), ("palette",)) == []
    assert len(validation.workflow_profile(flow | {"output_count": 0, "output_mode": "z", "canon_focus": ["q"], "runtime_defaults": {"seed_mode": "z"}}, ("id", "label"), ("sheet",), ("palette",))) == 6
    manifest = {"source_export_id": "e", "export_manifest_hash": "h", "config_fingerprint": "c", "training_profile_id": "p"}
    assert validation.training_manifest(manifest, "h", "c", ["p"]) == [] and len(validation.training_manifest(manifest, None, "d", [])) == 3


def test_brief():
    workflow = {"canon_focus": ["balance"], "prompt_strategy": {"style_prefix": ["inked"], "structure": "style_prefix, lane_goal, nothing, canon_focus"}, "negative_strategy": {"must_avoid": ["blur"]}, "drift_guards": ["no neon"], "runtime_defaults": {"steps": 8}}
    brief = briefs.compile_brief(workflow, t.PROJECT, "hull", briefs.Subject(negatives=("blur", "hat")), {"cfg": 2.0})
    assert brief.prompt == "inked, hull, Materials fit the group, Palette Stays In Range, Shapes agree" and brief.negative_prompt == "blur, hat"
    assert brief.constraints == ("[MAT-001] Materials fit the group", "[PAL-001] Palette Stays In Range", "[SHP-001] Shapes agree")
    assert brief.warnings == ("no neon", "[PAL-001] Off palette (%)") and (brief.runtime["steps"], brief.runtime["cfg"], brief.runtime["width"]) == (8, 2.0, 1024)


def test_references_and_subjects(spark):
    frame = records_of(spark, [record("a", lineage={"generation_role": "anchor"}), record("b", status="rejected"), record("ann_lee_1", identity={"subject_name": "Other"}), record("c", identity={"subject_name": "Ann Lee"})])
    wanted = spark.createDataFrame([("a",), ("b",), ("z",)], "id string")
    assert {r["record_id"]: (r["role"], r["problem"]) for r in briefs.references(wanted, frame).collect()} == {"a": ("anchor", None), "b": ("reference", "not approved: rejected"), "z": ("reference", "not found")}
    with pytest.raises(config.InputError):
        briefs.checked_references(wanted, frame)
    assert sorted(r["id"] for r in briefs.subject_records(frame, "Ann-Lee").collect()) == ["ann_lee_1", "c"]


def test_card(spark):
    profile = dataclasses.replace(t.SPLIT)
    text = card.render("set", {"total": 60, "included": 60, "excluded": 0}, split.create(families_frame(spark, 20, 3), profile), profile)
    assert "60 of 60 records (100.0%)" in text and "families in more than one part: 0" in text and card.percent(1, 0) == "—"


def test_brief_fingerprints(tmp_path):
    (tmp_path / "lanes.json").write_text("{}")
    base = briefs.fingerprint(tmp_path, {"b": 1, "a": [1.5]}, ["r2", "r1"])
    assert base == briefs.fingerprint(tmp_path, {"a": [1.5], "b": 1}, ["r1", "r2"]) and len(base) == 64
    assert base != briefs.fingerprint(tmp_path, {"b": 2, "a": [1.5]}, ["r1", "r2"]) and base != briefs.fingerprint(tmp_path, {"b": 1, "a": [1.5]}, [])
    (tmp_path / "lanes.json").write_text("[]")
    assert base != briefs.fingerprint(tmp_path, {"b": 1, "a": [1.5]}, ["r1", "r2"])
