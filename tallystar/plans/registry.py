"""Named queries: one Spark plan and (where SQL can say it) one DuckDB oracle each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    section: str


REGISTRY: dict[str, Query] = {}


def query(name: str, section: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, section)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    import importlib

    for mod in PLAN_MODULES:
        importlib.import_module(f"tallystar.plans.{mod}")
    return REGISTRY


PLAN_MODULES = ["q_warehouse", "q_audit", "q_sales", "q_basket", "q_series", "q_forecast",
                "q_stats", "q_planted"]
