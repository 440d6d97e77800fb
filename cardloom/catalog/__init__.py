"""Registered queries with the SQL that checks them."""

from __future__ import annotations

import importlib

MODULES = ("rows", "joins", "aggregates", "windows", "learning", "flows")


def load() -> dict:
    """Import every catalog module and return the registry."""
    from cardloom.catalog.base import REGISTRY
    for module in MODULES:
        importlib.import_module(f"cardloom.catalog.{module}")
    return dict(REGISTRY)
