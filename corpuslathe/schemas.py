"""Schemas of the crawl corpus and of the pages it is read from."""

from __future__ import annotations

from pyspark.sql.types import StructType

FOLDERS = StructType.fromDDL("folder_id string, parent_id string, name string, path string, depth bigint, reported_asset_count bigint, derived_direct_asset_count bigint")
PROMPTS = StructType.fromDDL("prompt_sha256 string, prompt_text string, source_prompt_chars bigint, analysis_prompt_chars bigint, url_redaction_count bigint, first_asset_id string")
ASSETS = StructType.fromDDL("asset_id string, folder_id string, item_type string, asset_type string, status string, job_set_type string, model string, created_at_unix double, width bigint, height bigint, duration_seconds double, resolution string, prompt_sha256 string, source_page bigint, source_item_index bigint, fetched_at string")
MEMBERSHIPS = StructType.fromDDL("asset_id string, folder_id string, first_seen_page bigint")
OCCURRENCES = StructType.fromDDL("page_number bigint, item_index bigint, asset_id string, item_type string, parse_status string")
ISSUES = StructType.fromDDL("page_number bigint, item_index bigint, asset_id string, severity string, code string, details_json string")
EVENTS = StructType.fromDDL("at string, level string, code string, details_json string")
