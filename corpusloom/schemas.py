"""Schemas of the engine's tables, as Spark DDL; nothing is inferred."""

DOCUMENT = "source_line_no long, doc_id string, text string, source_file string"
UNIT = "doc_id string, unit_id string, unit_seq int, char_start int, char_end int, text string, source_file string, source_line_no long"
JUDGMENT = "value boolean, certain boolean, signals array<string>, matches array<string>"
SCRIPT_JUDGMENT = JUDGMENT + ", decision_granularity string"
TOKEN = "surface string, pos string, dictionary_form string, normalized_form string, reading string"
SEGMENT = "surface string, reading string"
ENTRY = f"surface string, reading string, final_order int, piece_orders array<int>, original_segments array<struct<{SEGMENT}>>"
CANDIDATE = f"rank int, score double, entries array<struct<{ENTRY}>>"
RENDERED = f"strategy string, rendered string, certain boolean, sudachi array<struct<{TOKEN}>>, ngram_decoder array<struct<{CANDIDATE}>>, signals array<string>"
ANALYSIS = (
    f"mechanical struct<classical_japanese: struct<{JUDGMENT}>, minor_alphabetic_sequence: struct<{SCRIPT_JUDGMENT}>, yomi: struct<{RENDERED}>>, "
    "llm struct<classical_japanese: string, minor_alphabetic_sequence: string, yomi_is_correct: string, yomi_repair: string>, "
    "human_review struct<pass1: string, pass2: string, final_edit: string>"
)
OCCURRENCE = "occurrence_id string, doc_id string, unit_id string, unit_seq int, entity_text string, entity_key string, normalized string, char_start int, char_end int, component_texts array<string>, strict_case boolean, base_list_status string, resolved_status string"
DECISION = "entity_key string, strict_case boolean, status string, source string, note string"
EVIDENCE = "batch_name string, entity_key string, strict_case boolean, resolved_status string, base_list_status string, occurrence_count long, unit_count long, surface_forms array<string>, example_unit_ids array<string>"
LLM_JUDGMENT = "batch_name string, entity_key string, strict_case boolean, llm_status string, confidence string, note string, occurrence_count long, unit_count long, surface_forms array<string>, example_unit_ids array<string>, example_texts array<string>, source_path string"
PACK_ITEM = (
    "item_id string, seq int, entity_key string, strict_case boolean, proposed_action string, surface_forms array<string>, example_texts array<string>, note_samples array<string>, "
    "evidence struct<threshold_observations: long, supporting_observations: long, opposing_observations: long, supporting_batch_count: long, opposing_batch_count: long, source_batches: array<string>, confidence_counts: map<string, long>>"
)
PACK = f"schema_version int, review_stage string, pack_id string, created_at_epoch long, item_count int, track_name string, items array<struct<{PACK_ITEM}>>"
SUBMISSION = (
    "schema_version int, submission_type string, review_stage string, pack_id string, submission_id string, reviewer string, generated_at_epoch long, "
    "reviewed_ranges array<struct<from_seq: int, to_seq: int>>, overrides array<struct<item_id: string, decision: string, note: string>>"
)
USAGE = "input_tokens long, cached_input_tokens long, output_tokens long, reasoning_tokens long, total_tokens long"
PRICING = "model string, tier string, input_per_1m double, cached_input_per_1m double, output_per_1m double"
