"""Registered queries over the given tables and their independent SQL counterparts."""
