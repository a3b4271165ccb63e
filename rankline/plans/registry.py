"""Registry of named queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .inputs import Inputs, check_sql

_BUILD: dict[str, Callable[[Inputs], DataFrame]] = {}
_CHECK: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a query; ``check`` is SQL over the given and derived tables."""

    def wrap(build: Callable[[Inputs], DataFrame]):
        if name in _BUILD:
            raise ValueError(f"query {name} registered twice")
        _BUILD[name] = build
        if check is not None:
            _CHECK[name] = check
        return build

    return wrap


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: build(Inputs(spark, folder))

    return {name: bind(build) for name, build in _BUILD.items()}


def checks() -> dict[str, str]:
    return {name: check_sql(body) for name, body in _CHECK.items()}
