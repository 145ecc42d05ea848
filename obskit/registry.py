"""All queries of the library's own operators by name, and their SQL."""

from __future__ import annotations

from importlib import import_module

from .plans.base import ORACLE_SQL, QUERIES

for _name in ("standard", "screening", "space", "paired", "reports", "archive", "provenance", "sampling"):
    import_module(f"obskit.plans.{_name}")

__all__ = ["ORACLE_SQL", "QUERIES"]
