"""Batch jobs made of the operators, and the registered queries."""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "queries_scan", "queries_history", "queries_context",
    "queries_answers", "queries_vectors", "queries_bundle", "queries_stores", "queries_tables",
)


def load_queries():
    """(queries, oracles) of all query modules."""
    from intentloom.plans import registry

    for name in _MODULES:
        import_module(f"intentloom.plans.{name}")
    return registry.QUERIES, registry.ORACLES
