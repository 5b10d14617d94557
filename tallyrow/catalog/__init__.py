"""All registered queries."""

from __future__ import annotations

import importlib

from tallyrow.catalog.registry import ORACLES, QUERIES

for _module in ("quality", "plans", "fixing", "posting", "models", "retrieving", "roundtrips"):
    importlib.import_module(f"tallyrow.catalog.{_module}")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
