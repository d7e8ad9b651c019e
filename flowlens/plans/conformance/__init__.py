"""Registry of conformance queries (Spark) and their oracle SQL (DuckDB), by area."""

from __future__ import annotations

import importlib

_AREAS = ["flows", "labels", "metrics", "features", "live", "models"]


def _load():
    queries, oracle = {}, {}
    for area in _AREAS:
        m = importlib.import_module(f"flowlens.plans.conformance.{area}")
        queries.update(m.QUERIES)
        oracle.update(getattr(m, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _load()[0]


def all_oracle_sql():
    q, o = _load()
    return {k: v for k, v in o.items() if k in q}
