"""Registry of checked queries: one per operator, each with its oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables (or views
Spark derives from them). The oracle is DuckDB SQL over the same parquet
tables; ``None`` means the operator is checked by rows only.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

_MODULES = [
    "searchlake.plans.q_responses",
    "searchlake.plans.q_full_items",
    "searchlake.plans.q_logs",
    "searchlake.plans.q_scalars",
    "searchlake.plans.q_usage",
    "searchlake.plans.q_catalog",
    "searchlake.plans.q_reconcile",
    "searchlake.plans.q_ingest",
    "searchlake.plans.q_streaming",
]


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)


DUCK_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "json": "VARCHAR", "csv": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp": "TIMESTAMP"}
