"""Composed jobs and the registered queries."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLES, QUERIES

QUERY_MODULES = ("calls_queries", "table_queries", "text_queries", "model_queries")


def all_queries():
    """(queries, SQL) of every query module."""
    for name in QUERY_MODULES:
        import_module(f"{__name__}.{name}")
    return QUERIES, ORACLES
