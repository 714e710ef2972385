"""Graphs as two DataFrames: vertices (id, attributes) and edges (src, dst, attributes)."""
