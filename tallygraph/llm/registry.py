"""Queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from importlib import import_module

from tallygraph.queries.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = (
    "suffix_dedup",
    "substring_dedup",
    "url_rules",
    "metric_search",
    "decontaminate",
    "byte_pairs",
    "line_dedup",
    "simhash",
    "toxicity",
    "quality",
    "token_alignment",
    "spelling",
    "exact_dedup",
)


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries, by name, and their SQL."""
    for module in MODULES:
        part = import_module(f"tallygraph.llm.{module}")
        QUERIES[part.QUERY.__name__] = part.QUERY
        if part.ORACLE:
            ORACLES[part.QUERY.__name__] = part.ORACLE
    return QUERIES, ORACLES
