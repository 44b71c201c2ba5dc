"""Listings analytics on Spark: feeds and pages to a typed, clean, valued listings table."""

from lotwise.contract import CLEAN, CLEAN_COLUMNS, RAW, RAW_COLUMNS, SAMPLE_COLUMNS
from lotwise.operators.cleaning import Rules, clean, require_integrity, rule_audit
from lotwise.operators.feed import accepted, explode_envelopes, map_items, rejected
from lotwise.operators.market import freshness, market_summary, processed_summary, top_with_median
from lotwise.operators.merge import apply_details, conform, new_listings, unenriched, upsert
from lotwise.operators.pages import extract_details
from lotwise.operators.profiling import completeness, quality_gate
from lotwise.operators.valuation import market_index, value_requests
from lotwise.refresh import Refresh, refresh
from lotwise.sources.readers import read_clean, read_csv, read_feed, read_pages, read_raw, restore_json_cells, stored_ids
from lotwise.sources.writers import (
    encode_json_cells,
    sample_rows,
    write_clean,
    write_csv,
    write_raw,
    write_samples,
)
from lotwise.streaming.enrich import enriched_listings, start_enrichment
from lotwise.streaming.sync import start_sync, sync_report

__all__ = [
    "CLEAN",
    "CLEAN_COLUMNS",
    "RAW",
    "RAW_COLUMNS",
    "Refresh",
    "Rules",
    "SAMPLE_COLUMNS",
    "accepted",
    "apply_details",
    "clean",
    "completeness",
    "conform",
    "encode_json_cells",
    "enriched_listings",
    "explode_envelopes",
    "extract_details",
    "freshness",
    "map_items",
    "market_index",
    "market_summary",
    "new_listings",
    "processed_summary",
    "quality_gate",
    "read_clean",
    "read_csv",
    "read_feed",
    "read_pages",
    "read_raw",
    "refresh",
    "rejected",
    "require_integrity",
    "restore_json_cells",
    "rule_audit",
    "sample_rows",
    "start_enrichment",
    "start_sync",
    "stored_ids",
    "sync_report",
    "top_with_median",
    "unenriched",
    "upsert",
    "value_requests",
    "write_clean",
    "write_csv",
    "write_raw",
    "write_samples",
]
