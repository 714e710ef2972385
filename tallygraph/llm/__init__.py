"""Operators of a training-data pipeline: deduplication, filters, search, classifiers, tokens."""
