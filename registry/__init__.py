"""Queries over the given tables, each with the SQL that defines its result."""

from __future__ import annotations

import importlib

from registry.base import Query

MODULES = ("facts", "cleaning", "merging", "places", "context", "storage")


def all_queries() -> list[Query]:
    found: list[Query] = []
    for name in MODULES:
        found += importlib.import_module(f"registry.{name}").QUERIES
    return found
