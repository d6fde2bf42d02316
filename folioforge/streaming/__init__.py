"""Incremental plans."""
