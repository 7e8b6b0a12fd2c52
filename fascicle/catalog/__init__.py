"""Every operator run over the benchmark tables, next to the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from .registry import CASES, Case

MODULES = ("relational", "scalars", "storage", "text", "search", "models", "checks", "flows")


def cases() -> dict[str, Case]:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return CASES
