"""Iterative learning on tables."""
