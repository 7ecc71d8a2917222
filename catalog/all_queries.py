"""Importing this module registers every query."""

import importlib
import pkgutil

import catalog
from catalog.registry import ORACLES, QUERIES  # noqa: F401

for _m in sorted(m.name for m in pkgutil.iter_modules(catalog.__path__)):
    if _m not in ("all_queries", "registry", "views", "compare"):
        importlib.import_module(f"catalog.{_m}")
