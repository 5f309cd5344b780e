"""Operators for preparing training text: deduplication, classification, fingerprints, scans and token output."""
