"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ("windows", "labels", "scoring", "evaluation", "joins", "models", "streams")


def load_registry():
    for module in MODULES:
        importlib.import_module(f"panelith.plans.{module}")
    from panelith.plans.registry import REGISTRY

    return REGISTRY
