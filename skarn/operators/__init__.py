"""Relational, graph, search and quality operators over tables."""
