"""Operators for preparing training text: filtering, deduplication, scoring, tokenising, packing, extraction, search."""
