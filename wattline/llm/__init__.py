"""Operators for preparing training text: deduplication, scans, scoring, tokens, packing."""
