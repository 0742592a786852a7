"""Explicit schemas. Records are wide, nested and mostly optional, so they are never inferred."""

from __future__ import annotations

ASSERTION = "rule_id string, category string, verdict string, score double, rationale string, faction string, faction_context string"

RECORD = f"""
id string, schema_version string, created_at string, asset_path string,
image struct<format:string,width:int,height:int,bytes:bigint>,
provenance struct<workflow_id:string,prompt:string,negative_prompt:string,seed:bigint,steps:int,cfg:double,loras:array<struct<name:string,weight:double>>,generation_time_ms:bigint,source:string,selection_id:string>,
judgment struct<status:string,reviewer:string,reviewed_at:string,explanation:string,criteria_scores:map<string,double>,failure_modes:array<string>,improvement_notes:string,confidence:double>,
canon struct<constitution_version:string,bound_at:string,bound_by:string,faction:string,assertions:array<struct<{ASSERTION.replace(" string", ":string").replace(" double", ":double")}>>,assertion_count:int,pass_count:int,fail_count:int,partial_count:int,forbidden_inputs:array<string>>,
identity struct<subject_name:string,subject_id:string,subject_type:string,faction:string,role:string,species:string,kind:string,view_type:string,stable_traits:array<string>,prohibited_drift:array<string>>,
lineage struct<derived_from_record_id:string,generation_role:string>,
iteration int, rights_status string, training_rights_status string, dataset_tags array<string>, tags array<string>
"""

TRAINING_ROW = """
schema_version string, generated_from string, entity_id string, schema_kind string, entity_type string, lane string, partition string,
asset_path string, caption string, trigger string, subject_filter_key string, forbidden_tokens array<string>, entry_hash string, pass_ratio double, group string
"""
RECORD_SCHEMA_VERSION = "2.0.0"
ROW_SCHEMA_VERSION = "canon-build-dataset-1.0"

EVAL_OUTPUT = "record_id string, generated_path string, accept boolean, notes string"

FREEZE_EVENT = """
at string, build_hash string, type string, entity_id string, schema_kind string, by string, reason string,
prior_status string, new_status string, watch_fields array<string>, prior_build_hash string
"""

BATCH_SLOT = "slot_id string, label string, brief_id string, run_id string, status string, selected_output string, error string"

BOX_LABEL = "image string, count int, seed bigint, bboxes_xywh array<array<int>>"
