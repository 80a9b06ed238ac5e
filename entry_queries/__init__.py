"""Queries over the given tables, each with an independent SQL statement of its result."""

from importlib import import_module

MODULES = ("extract", "changes", "metadata", "texts")


def all_queries() -> dict:
    """``name -> (function, sql or None)`` of every module."""
    found = {}
    for module in MODULES:
        found.update(import_module(f"{__name__}.{module}").QUERIES)
    return found
