"""Queries on the supplied tables, one module per area."""

from __future__ import annotations

from importlib import import_module

from netloom.queries.registry import Registry

MODULES = ("scoring", "entities", "linking", "texts", "relational", "files")


def all_queries() -> Registry:
    found = Registry()
    for module in MODULES:
        found.update(import_module(f"netloom.queries.{module}").QUERIES)
    return found
