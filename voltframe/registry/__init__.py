"""Every operator as a query over the given tables, next to an independent SQL statement of it."""

from __future__ import annotations

import importlib

from voltframe.registry.base import ORACLES, QUERIES, Query

_MODULES = ["facts", "changes", "checks", "planning", "measures", "documents", "arrivals", "stored", "streams"]


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"{__name__}.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
