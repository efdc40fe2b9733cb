"""Input adapters, the materialised warehouse and the query registry."""

from __future__ import annotations

import importlib

_MODULES = ["queries_silver_gold", "queries_serving", "queries_sources", "queries_models", "queries_streams", "queries_carry", "queries_ranges"]


def all_entries() -> dict:
    """The registry, filled by importing every query module."""
    for name in _MODULES:
        importlib.import_module(f"tidewatch.plans.{name}")
    from tidewatch.plans.registry import REGISTRY

    return REGISTRY
