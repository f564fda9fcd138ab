"""Operators for preparing training text: counting, scanning, mixing, deduplication, encoding, search."""
