"""Operators for large text corpora: scoring, deduplication, search, sharding, tokens."""
