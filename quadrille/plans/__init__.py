"""Queries over the given tables, one per capability, each with the same result as SQL where SQL can say it."""

from importlib import import_module

from .base import QUERIES, SQL

MODULES = ("files", "matching", "aggregates", "updates", "forms", "mappings", "reasoning", "validation", "names", "upkeep")


def load() -> tuple[dict, dict]:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return dict(QUERIES), dict(SQL)
