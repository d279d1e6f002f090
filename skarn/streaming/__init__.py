"""Incremental maintenance and event streams."""
