"""Incremental versions of ingestion, rule checks and scoring."""
