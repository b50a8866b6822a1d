"""Helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, tuple[Query, str | None]] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with DuckDB SQL of the same result if there is one."""

    def add(f: Query) -> Query:
        _registry[name or f.__name__] = (f, oracle)
        return f

    return add


def registered() -> dict[str, tuple[Query, str | None]]:
    return dict(_registry)
