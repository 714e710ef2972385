"""The registered queries, each with the SQL that must give the same result where SQL can."""

from __future__ import annotations

from importlib import import_module

from tallygraph.queries.registry import ORACLES, QUERIES

for _name in ("relational", "storage", "relations", "graphs", "logs", "learning", "streams"):
    import_module(f"tallygraph.queries.{_name}")

__all__ = ["ORACLES", "QUERIES"]
