"""Every registered query with its SQL, gathered from the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function (spark, sf_dir) under ``name``, with the DuckDB SQL for the same rows where SQL can express it."""

    def put(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return put


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def load_all() -> None:
    """Imports every module of queries, each of which registers its own."""
    from importlib import import_module
    from pkgutil import iter_modules

    from strandline import plans

    for m in iter_modules(plans.__path__):
        if m.name.startswith("q_"):
            import_module(f"strandline.plans.{m.name}")
