"""Every operator as a named query over the test tables, with the same question in SQL."""

from __future__ import annotations

import importlib

SECTIONS = ("storage", "shaping", "joining", "totals", "scalars", "reporting", "checking")


def load():
    """(queries, oracle statements), in inventory order."""
    from salesmart.catalog.registry import ORACLE, QUERIES

    for section in SECTIONS:
        importlib.import_module(f"salesmart.catalog.{section}")
    return dict(sorted(QUERIES.items())), dict(sorted(ORACLE.items()))
