"""Readers and writers of bundles, lines and graph tables."""
