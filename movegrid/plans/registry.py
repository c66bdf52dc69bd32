"""All registered queries and their SQL twins."""
from __future__ import annotations

import importlib

_MODULES = [
    "movegrid.plans.track_queries",
    "movegrid.plans.catch_queries",
    "movegrid.plans.grid_queries",
    "movegrid.plans.feature_queries",
    "movegrid.plans.image_queries",
    "movegrid.plans.report_queries",
    "movegrid.plans.run_queries",
]


def _load():
    queries, oracle = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(name)
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
