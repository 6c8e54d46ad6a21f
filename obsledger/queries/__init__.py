"""Registered queries: a Spark callable and, where SQL can say it, the same result as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL twin."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load_all() -> None:
    """Import every query module once."""
    from obsledger.queries import (  # noqa: F401
        aggregates, catalogue, cleaning, forecasts, jobs, learned, profiling, timelines,
    )
