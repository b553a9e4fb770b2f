"""Registered queries and, beside each, the same result written as SQL for another engine."""

from __future__ import annotations

import importlib
import pkgutil


def load_all():
    """(queries, oracle SQL), importing every module of the catalog once."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    from catalog.base import ORACLE, QUERIES

    return dict(QUERIES), dict(ORACLE)
