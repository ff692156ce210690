"""Named queries over the supplied tables, each with its oracle SQL if any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from tallyhouse.registry import (  # noqa: F401
        cleaning,
        health,
        jobs,
        listings,
        loading,
        sales,
        structure,
        upkeep,
    )
