"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

from scoreloom.catalog.registry import ORACLES, QUERIES, Query

MODULES = ("cleaning", "features", "sampling", "scoring", "measures", "combine", "reporting", "learners")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"scoreloom.catalog.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
