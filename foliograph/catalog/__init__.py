"""Registered queries on the driver tables, each next to its SQL."""

from __future__ import annotations

import importlib
import pkgutil

from foliograph.catalog.registry import ORACLES, QUERIES


def load():
    """All queries and their SQL, from every module of this package."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if module != "registry":
            importlib.import_module(f"{__name__}.{module}")
    return QUERIES, ORACLES
