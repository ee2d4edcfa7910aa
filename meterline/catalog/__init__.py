"""Registered queries: name, DataFrame function and the SQL it is checked against."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_MODULES = ["reports", "windowed", "columns", "models", "files", "tables", "streams", "checks"]


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None, name: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a function under its own name, with the inventory ids it covers."""
    def add(fn: QueryFn) -> QueryFn:
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} registered twice")
        REGISTRY[key] = Query(key, covers, fn, sql)
        return fn
    return add


def load_all() -> dict[str, Query]:
    for module in _MODULES:
        importlib.import_module(f"meterline.catalog.{module}")
    return REGISTRY
