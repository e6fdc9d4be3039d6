"""Query plans of the core, by module."""

from __future__ import annotations

import importlib
import pkgutil


def registries() -> list:
    """The registries of this package's modules."""
    mods = (importlib.import_module(f"{__name__}.{m.name}") for m in pkgutil.iter_modules(__path__))
    return [m.REG for m in mods if hasattr(m, "REG")]
