"""Operators for preparing training data: scoring, deduplication, mixing, tokens, search and web archives."""
