"""Queries over the test tables."""

from __future__ import annotations

import importlib

GROUPS = ("scalars", "filters", "aggregates", "joins", "series", "labels", "sampling", "files")


def load():
    """The registry with every query module imported."""
    for name in GROUPS:
        importlib.import_module(f"{__name__}.{name}")
    return importlib.import_module(f"{__name__}.registry")
