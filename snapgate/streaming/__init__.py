"""Incremental operation."""
