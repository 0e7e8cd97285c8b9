"""Structured Streaming versions of file arrival and scoring."""
