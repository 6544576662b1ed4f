"""Schemas of the project's tables, as DDL, and what may stand in their columns."""

from __future__ import annotations

BBOX = "struct<x0:double,y0:double,x1:double,y1:double>"
TABLES = {
    "source_files": "document_id string, file_name string, source_path string, sha256 string, page_count int, status string, metadata_json string, created_at timestamp, updated_at timestamp",
    "page_layout": "document_id string, page_no int, width double, height double, rotation int",
    "blocks": f"block_id string, document_id string, page_no int, block_type string, bbox {BBOX}, reading_order int, raw_content string, resolved_content string, source string, asset_id string, section_path array<string>, issue_flags array<string>, status string, text_level int, column_index int, skip_chunk boolean, chunk_eligible boolean, source_pages array<int>, processing_tags array<string>, metadata_json string",
    "block_revisions": "revision_id string, block_id string, revision_no int, source string, content string, created_at timestamp",
    "chunks": "chunk_id string, document_id string, page_start int, page_end int, block_type string, parent_id string, section_path string, display_text string, embedding_text string, asset_id string, bbox_json string, metadata_json string, embedding_state string",
    "vlm_results": "result_id string, block_id string, document_id string, page_no int, task string, readable boolean, text string, html string, latex string, summary string, structured_data string, uncertainty array<string>, evidence array<string>, is_continuation boolean, column_mapping array<struct<source:string,target:string>>, created_at timestamp, received_at timestamp",
    "workflow_events": "event_id string, run_id string, stage string, status string, message string, details_json string, written_at timestamp",
    "vectors": "chunk_id string, dense_vector array<float>, dim int",
    "text_lines": f"document_id string, page_no int, line_no int, text string, bbox {BBOX}",
    "questions": "id string, question string, expected_answer string, page_no int, page_range array<int>, modality string, difficulty string, answer_evidence string, must_retrieve_keywords array<string>",
}
