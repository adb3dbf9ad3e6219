"""Registry of named queries: Spark plan + optional DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; its
oracle is an independent SQL statement over the same tables. Queries that
SQL cannot express (model fitting, LSH, streaming) register without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
BENCH: list[str] = []


def register(name: str, oracle: str | None = None, bench: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        if bench:
            BENCH.append(name)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    import importlib
    import pkgutil

    import quire.plans as pkg
    for m in sorted(pkgutil.iter_modules(pkg.__path__), key=lambda m: m.name):
        if m.name not in ("registry", "common"):
            importlib.import_module(f"quire.plans.{m.name}")
