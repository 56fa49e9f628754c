"""Incremental stages."""
