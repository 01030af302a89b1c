"""Registered queries: each takes (spark, directory) and returns a DataFrame."""

from __future__ import annotations

from importlib import import_module

from waybill.catalog import registry

MODULES = ("reports", "tables", "probability", "spread", "models", "series")


def _load() -> None:
    for name in MODULES:
        import_module(f"waybill.catalog.{name}")


def queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
