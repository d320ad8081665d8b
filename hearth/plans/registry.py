"""Name -> plan and name -> oracle SQL of the listings queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("market", "search", "parsing", "dedup", "features", "streams", "more", "serve", "stored", "service")

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

for _module in MODULES:
    for _name, (_plan, _sql) in import_module(f"hearth.plans.{_module}").PLANS.items():
        QUERIES[_name] = _plan
        if _sql:
            ORACLE_SQL[_name] = _sql
