"""Imports every module that registers queries."""

from __future__ import annotations

import importlib

MODULES = ["cleaning", "joins", "aggregates", "dashboards", "statistics", "retrieval", "sources", "streaming", "models"]


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"tillwise.catalog.{module}")
