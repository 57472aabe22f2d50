"""Named queries over the given tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "metric_queries",
    "record_queries",
    "entity_queries",
    "flow_queries",
    "kpi_queries",
    "stream_queries",
    "edge_queries",
)


def load_registry():
    """All registered queries, in module order."""
    for module in MODULES:
        import_module(f"tarnlake.registry.{module}")
    from tarnlake.registry.base import REGISTRY

    return REGISTRY
