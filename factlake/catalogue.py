"""All queries of the library and their SQL, gathered from the plan modules."""

from __future__ import annotations

import importlib
import pkgutil

from . import plans
from .plans import registry


def _load() -> None:
    for module in pkgutil.iter_modules(plans.__path__):
        if module.name.endswith("_queries"):
            importlib.import_module(f"{plans.__name__}.{module.name}")


def queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.SQL)
