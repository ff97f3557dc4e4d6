"""Operators for building training corpora: search, filtering, deduplication, mixing, formatting and packing."""
