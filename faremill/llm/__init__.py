"""Operators for preparing training text: filters, deduplication, mixing, tokens and vector search."""
