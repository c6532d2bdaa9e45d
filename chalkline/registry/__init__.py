"""Queries on the star-schema test tables, with the SQL each must agree with."""

from __future__ import annotations

import importlib

MODULES = ("generic", "tables", "reports")


def load():
    """(queries, oracle SQL) of all registry modules."""
    for module in MODULES:
        importlib.import_module(f"chalkline.registry.{module}")
    from chalkline.registry.base import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
