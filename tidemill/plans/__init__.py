"""Queries bound to the driver tables; importing this package fills the registry."""

from importlib import import_module

from tidemill.plans.registry import REGISTRY, Query, Tables, query

MODULES = ["ingest", "basics", "joining", "measuring", "ranking", "changing", "cleaning", "checking", "streams"]

for _module in MODULES:
    import_module(f"tidemill.plans.{_module}")

__all__ = ["REGISTRY", "Query", "Tables", "query"]
