"""Registered queries over the driver's tables, with their ANSI SQL equivalents."""

import importlib
import pkgutil

from tidemark.plans.registry import CATALOG


def catalog():
    """All registered queries, in name order."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return dict(sorted(CATALOG.items()))


__all__ = ["catalog"]
