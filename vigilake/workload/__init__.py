"""Queries registered for the driver, grouped like the operators."""

from __future__ import annotations

from importlib import import_module

MODULES = ["feature_queries", "event_queries", "model_queries", "threat_queries", "response_queries", "stream_queries"]


def load_queries() -> dict:
    from vigilake.workload.registry import REGISTRY

    for module in MODULES:
        import_module(f"vigilake.workload.{module}")
    return dict(REGISTRY)
