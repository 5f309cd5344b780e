"""Structured Streaming jobs: CDC ingestion to bronze/quarantine, and the notifier."""
