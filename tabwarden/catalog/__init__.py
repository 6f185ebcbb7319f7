"""Named queries over the given tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

MODULES = ("ingest", "profiling", "validation", "evaluation", "lifecycle", "features", "models", "streams", "labels")


def _modules():
    return [import_module(f"{__name__}.{m}") for m in MODULES]


def queries() -> dict:
    return {name: q for m in _modules() for name, q in m.QUERIES.items()}


def oracles() -> dict:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
