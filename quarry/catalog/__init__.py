"""Registered checks: each entry is a Spark query built from quarry operators
over the given tables (or inputs Spark derives from them) plus, where SQL can
express it, an independent oracle written in plain SQL for DuckDB."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    from quarry.catalog import (evaluation, statistics, profiling, preparation,  # noqa: F401
                                selection, splitting, models)
