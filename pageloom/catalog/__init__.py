"""Registered queries: each operator over the given tables, with its SQL counterpart."""

from __future__ import annotations

import importlib
import os

MODULES = [
    "urls", "frontier", "pages", "cleaning", "joins", "runs", "health", "changes", "quality", "sources", "streams", "trends",
]


def load():
    from pageloom.catalog import base

    here = os.path.dirname(__file__)
    for name in MODULES:
        if os.path.exists(f"{here}/{name}.py"):
            importlib.import_module(f"pageloom.catalog.{name}")
    return base.QUERIES, base.ORACLES
