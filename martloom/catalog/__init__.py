"""The registered queries, one module per family."""

from __future__ import annotations

import importlib

from martloom.catalog import registry

FAMILIES = ("marts", "kpis", "relational", "functions", "quality", "history", "files", "streams", "logs", "batch")


def _load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"martloom.catalog.{family}")


def all_queries():
    _load()
    return dict(registry.QUERIES)


def all_oracles():
    _load()
    return dict(registry.ORACLES)
