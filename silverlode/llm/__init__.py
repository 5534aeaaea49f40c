"""Operators that prepare training text: search, deduplication, identification, scans, packing, scoring, privacy, chat."""
