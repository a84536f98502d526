"""The registered queries."""

from __future__ import annotations

import importlib

MODULES = ("prepare", "evaluation", "history", "monitoring", "tracking", "training", "files", "flows")


def all_queries():
    """Queries and their SQL, by name."""
    for name in MODULES:
        importlib.import_module(f"tabmill.plans.{name}")
    from tabmill.plans.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
