"""Structured Streaming forms: file ingest, outcomes, stuck runs, duplicate arrivals, intraday state."""
