"""Streaming queries: each operator takes and returns a streaming DataFrame."""
