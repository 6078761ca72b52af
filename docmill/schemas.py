"""Declared schemas of the stages' records, and the taxonomies."""

from __future__ import annotations

META = "STRUCT<page_start INT, page_end INT, num_pages INT, block_types ARRAY<STRING>, has_table BOOLEAN, has_formula BOOLEAN, has_heading BOOLEAN>"
EQUATIONS = "ARRAY<STRUCT<latex STRING, description STRING, variables ARRAY<STRUCT<symbol STRING, name STRING, unit STRING>>>>"
SEMANTIC = (
    "STRUCT<language STRING, content_type ARRAY<STRING>, domain ARRAY<STRING>, artifact_role ARRAY<STRING>, chunk_role ARRAY<STRING>, "
    f"trust_level STRING, summary_short STRING, equations {EQUATIONS}, key_quantities ARRAY<STRING>, "
    "meta STRUCT<mode STRING, used_prev_next BOOLEAN, used_faiss BOOLEAN, faiss_neighbors ARRAY<STRING>, "
    "empty_reasons STRUCT<content_type STRING, domain STRING, artifact_role STRING, summary_short STRING>>>"
)
NORMALIZED = f"doc_id STRING, chunk_id STRING, source_type STRING, source_path STRING, title STRING, language STRING, content STRING, meta {META}"
SOURCE_REF = "STRUCT<chunk_id STRING, doc_id STRING, source_path STRING, title STRING, page_start INT, page_end INT>"
PROVENANCE = (
    "STRUCT<faiss STRUCT<metric STRING, index_type STRING, normalized BOOLEAN, neighbor_chunk_ids ARRAY<STRING>, neighbor_scores ARRAY<DOUBLE>>, "
    "local_neighbor_chunk_ids ARRAY<STRING>, config_hash STRING, "
    "prompts STRUCT<double_pass BOOLEAN, plan_system_hash STRING, plan_user_hash STRING, gen_system_hash STRING, gen_user_hash STRING>, "
    "system_prompt_hash STRING, user_template_hash STRING, llm MAP<STRING, STRING>, "
    "plan STRUCT<equations_present BOOLEAN, equation_quotes ARRAY<STRING>, generator_checks ARRAY<STRING>, takeaways ARRAY<STRUCT<takeaway STRING, evidence_chunks ARRAY<STRING>>>>>"
)
CANDIDATE = (
    "id STRING, anchor_chunk_id STRING, anchor_doc_id STRING, context_chunks ARRAY<STRING>, source_chunks ARRAY<STRING>, question STRING, "
    "answer STRING, difficulty STRING, language STRING, content_type ARRAY<STRING>, domain ARRAY<STRING>, trust_level STRING, workspace STRING, topic STRING"
)
#: The whole record that candidate generation writes.
CANDIDATE_RECORD = f"{CANDIDATE}, source_refs ARRAY<{SOURCE_REF}>, context_refs ARRAY<{SOURCE_REF}>, doc_ids ARRAY<STRING>, workspace_file STRING, provenance {PROVENANCE}"

#: The ids of the taxonomies, in their order.
TAXONOMY = {
    "content_type": [
        "textbook", "paper", "norm", "software_handbook", "guideline", "best_practice_doc", "meeting_notice", "management_ppt", "expert_ppt",
        "code_internal", "code_external", "experiment_supplier_doc", "experiment_internal_doc", "spreadsheet", "lab_report", "simulation_report",
    ],
    "domain": [
        "simulation", "gt_power", "cfd", "test_driving", "laboratory", "component_test", "research", "programming", "documentation", "guidelines",
        "thermodynamics", "combustion", "controls", "hpc",
    ],
    "artifact_role": [
        "measurement_data", "simulation_result", "test_result", "assumption", "target_spec", "statement", "test_definition", "procedure", "report_summary",
    ],
    "chunk_role": ["definition", "derivation", "example", "exercise", "explanation", "summary"],
    "trust_level": ["high", "medium", "low"],
    "language": ["de", "en", "mixed", "unknown"],
}
