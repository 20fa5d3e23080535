"""Incremental feeds."""
