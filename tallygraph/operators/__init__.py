"""Relational operators: filters, joins, grouping, skew handling and layout."""
