"""Incremental publishing."""
