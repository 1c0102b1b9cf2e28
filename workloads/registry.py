"""Queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


MODULES = (
    "cleaning_queries",
    "segment_queries",
    "value_queries",
    "churn_queries",
    "master_queries",
    "model_queries",
)


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"workloads.{module}")


def queries() -> dict[str, Query]:
    _load()
    return QUERIES


def oracles() -> dict[str, str]:
    _load()
    return ORACLES
