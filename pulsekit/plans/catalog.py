"""Registry of named queries (Spark) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> tuple[dict, dict]:
    """Import every query module (registration happens on import)."""
    from pulsekit.plans import q_base, q_stats  # noqa: F401

    for mod in ("q_drift", "q_registry", "q_sources", "q_models"):
        try:
            __import__(f"pulsekit.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"pulsekit.plans.{mod}":
                raise
    return QUERIES, ORACLES
